"""Byte-level BPE: higher-order functions fold ranked merges over the byte arrays of words.

1. *Distinct words.* Texts are split by the vocabulary's pattern; the words are counted over
   the whole corpus.
2. *Fold.* The `lexicon_size` most frequent words, a bounded number, are encoded once by
   Spark functions: a word is an array of its bytes; each step of a fold looks up the rank of
   every adjacent pair in the literal rank map and joins the lowest-ranked, leftmost of
   equals; a word that is itself a token is left whole, as the tiktoken library does.
3. *Literal map.* Spark looks maps up entry by entry, so the rank map is a perfect hash:
   literal arrays of displacements, keys and values, one probe a look-up.
4. *Texts.* An Arrow pass splits each text again and takes its words' ids from the lexicon.
   Words that are no entries are merged there by the same ranks, many at a time (long ones
   with a heap), and kept for the texts to come as memory allows.
5. *Decoding* concatenates the tokens' binary pieces, by Spark functions.

All of it can be done by Spark functions (`encode_by_fold`), at several times the CPU: the
README has the figures.

The pattern's `\\s` is Unicode white space; `\\p{L}` and `\\p{N}` are those of the JVM's, or in
the Arrow pass the regex module's, Unicode version.

Defined results: null text is empty: no ids; empty and very long texts and words are encoded
whole; repeated rows and null doc_ids are encoded each for itself; other columns stay, `ids`
is added (an own column of that name is replaced); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinculum.llm import bpe
from vinculum.llm.common import fresh, kept_by, over_batches, slices, stage, worker
from vinculum.llm.tokens import ChunkIds, texts_of

LEXICON_SIZE = 65_536
#: Longest word of the lexicon.
ENTRY_BYTES = 32

#: The white space of Unicode, as a Java character class without brackets.
WHITE_SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def java_pattern(pattern: str) -> str:
    """The pattern in Java's syntax with Unicode white space."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out.append(WHITE_SPACE if inside else f"[{WHITE_SPACE}]")
            i += 2
        elif two == r"\S" and not inside:
            out.append(f"[^{WHITE_SPACE}]")
            i += 2
        elif two[0] == "\\":
            out.append(two)
            i += 2
        else:
            inside = two[0] == "[" or inside and two[0] != "]"
            out.append(two[0])
            i += 1
    return "".join(out)


class LiteralMap:
    """A map with byte strings as keys, as literal arrays that are probed once a look-up.

    Keys fall into buckets by their hash; each bucket has the first displacement that sends its
    keys to free slots (larger buckets choose first).
    """

    def __init__(self, entries: dict[bytes, object], kind: str) -> None:
        import xxhash

        keys = list(entries)
        h = np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), np.uint64, len(keys))
        size = 1 << max(10, (len(keys) * 5 // 4).bit_length())
        while (placed := self._placed(h, size)) is None:
            size *= 2
        moves, slots = placed
        at: list[object] = [None] * size
        values: list[object] = [None] * size
        for key, slot in zip(keys, slots):
            at[slot], values[slot] = base64.b64encode(key).decode(), entries[key]
        self.moves = _literal(moves, "array<long>")
        self.keys = _literal(at, "array<binary>")
        self.values = _literal(values, f"array<{kind}>")

    def _placed(self, h: np.ndarray, size: int) -> tuple[list[int], list[int]] | None:
        """Displacement of each bucket and slot of each key; None if a bucket finds no slots."""
        self.bucket_mask, self.slot_mask = size // 4 - 1, size - 1
        base = ((h >> np.uint64(20)) & np.uint64(0xFFFFFF)).astype(np.int64)
        step = ((h >> np.uint64(44)) | np.uint64(1)).astype(np.int64)
        bucket = (h & np.uint64(self.bucket_mask)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        members = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(h) else []
        moves, out = [0] * (self.bucket_mask + 1), [0] * len(h)
        free = np.ones(size, bool)
        for part in sorted(members, key=len, reverse=True):
            for first in range(0, size, 64):
                slots = (base[part] + np.arange(first, first + 64)[:, None] * step[part]) & self.slot_mask
                ok = free[slots].all(axis=1)
                if len(part) > 1:
                    ordered = np.sort(slots, axis=1)
                    ok &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if ok.any():
                    break
            else:
                return None
            row = int(ok.argmax())
            moves[int(bucket[part[0]])] = first + row
            free[slots[row]] = False
            for k, slot in zip(part.tolist(), slots[row].tolist()):
                out[k] = slot
        return moves, out

    def get(self, keys: Column) -> Column:
        """The value of each element of an array of binary keys; null where there is none."""
        long = lambda x: F.lit(x).cast("long")

        def slot(h: Column) -> Column:
            move = F.get(self.moves, h.bitwiseAND(long(self.bucket_mask)).cast("int"))
            base = F.shiftrightunsigned(h, 20).bitwiseAND(long(0xFFFFFF))
            step = F.shiftrightunsigned(h, 44).bitwiseOR(long(1))
            return (base + move * step).bitwiseAND(long(self.slot_mask)).cast("int")

        def probed(keys: Column) -> Column:
            slots = F.transform(F.transform(keys, lambda k: F.xxhash64(k)), slot)
            return F.zip_with(keys, slots, lambda k, s: F.when(F.get(self.keys, s) == k, F.get(self.values, s)))

        return _let(keys, probed)


def _literal(values: list, kind: str) -> Column:
    """A literal array: JSON text that the optimizer reads once (binary as base64)."""
    return F.from_json(F.lit(json.dumps(values)), kind)


@dataclass(frozen=True, eq=False)
class Vocabulary:
    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """From a file with a base64 token and its rank on each line."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}, pattern)

    @cached_property
    def rank_map(self) -> LiteralMap:
        return LiteralMap(self.ranks, "int")

    @cached_property
    def tokens(self) -> Column:
        """The bytes of each id, as a literal array."""
        by_id: list[str | None] = [None] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            by_id[rank] = base64.b64encode(token).decode()
        return _literal(by_id, "array<binary>")

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(java_pattern(self.pattern)), F.lit(0))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def folded(word: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a word (binary, not empty) by the fold."""
    ranks = vocabulary.rank_map

    def merged(parts: Column) -> Column:
        rest = F.slice(parts, F.lit(2), F.size(parts))
        joined = F.zip_with(parts, rest, lambda a, b: F.concat(a, b))

        def at_best(at: Column) -> Column:  # 1-based place of the pair to join; null without one
            pair = F.array(F.concat(F.get(parts, at - 1), F.get(parts, at)))
            return F.concat(F.slice(parts, F.lit(1), at - 1), pair, F.slice(parts, at + 2, F.size(parts)))

        best = _let(ranks.get(joined), lambda r: F.array_position(r, F.array_min(r)).cast("int"))
        return F.coalesce(_let(best, at_best), parts)

    n = F.octet_length(word)
    letters = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(word, i, F.lit(1)))
    steps = F.slice(F.sequence(F.lit(1), n), F.lit(2), n)
    parts = F.aggregate(steps, letters, lambda parts, _: merged(parts))
    return _let(ranks.get(F.array(word)), lambda whole: F.when(whole[0].isNotNull(), whole).otherwise(ranks.get(parts)))


class ByteMerger(bpe.Merger):
    """Ids of words by the ranks of byte strings: a pair's rank is the id of what it makes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.whole = ranks
        pairs = [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.merges = {(left, right): (rank, rank) for left, right, rank in pairs}
        keys = np.array([left << 20 | right for left, right, _ in pairs], np.int64)
        made = np.array([rank for _, _, rank in pairs], np.int32)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], made[order]
        self.none = np.int32(max(ranks.values(), default=0) + 1)
        self.made = np.arange(self.none, dtype=np.int32)
        self.inner = self.last = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)

    def many(self, chunks: list[bytes]) -> list[list[int]]:
        split = [w for w in chunks if w not in self.whole]
        merged = dict(zip(split, self._merged([w.decode("latin-1") for w in split])))
        return [[self.whole[w]] if w in self.whole else merged[w] for w in chunks]


def _counted(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, n): how often each word of up to ENTRY_BYTES occurs."""
    words = docs.select(F.explode(vocabulary.words(F.col("text"))).alias("word")).filter(F.octet_length("word") <= ENTRY_BYTES)
    return words.groupBy("word").agg(F.count("*").alias("n"))


def lexicon(docs: DataFrame, vocabulary: Vocabulary, size: int) -> dict[bytes, list[int]]:
    """The ids of at most `size` words of `docs`: all that occur at least as often as the
    rarest of them, and twice or more.

    The least count comes from a table of words per count, so nothing is sorted whole; only
    the entries, short and bounded in number, reach the driver.
    """
    words = stage(_counted(docs, vocabulary).filter("n > 1"), "byte-bpe-counts")
    exact = 4096  # counts from here on share a cell per power of two, which bounds the table
    cell = F.when(F.col("n") < exact, F.col("n")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("long"))
    least, taken = None, 0
    for row in sorted(words.groupBy(cell.alias("n")).agg(F.count("*").alias("words")).collect(), reverse=True):
        if taken + row["words"] > size:
            break
        least, taken = row["n"], taken + row["words"]
    if least is None:
        return {}
    chosen = words.filter(F.col("n") >= least).select(F.col("word").cast("binary").alias("word"))
    coded = stage(chosen.select("word", folded(F.col("word"), vocabulary).alias("ids")), "byte-bpe-lexicon")
    return {bytes(r["word"]): r["ids"] for r in coded.collect()}


class WordIds(ChunkIds):
    """Ids of words: an entry's from the lexicon, other words' by merging."""

    def __init__(self, merger: ByteMerger, entries: dict[bytes, list[int]]) -> None:
        self.merger, self.entries = merger, entries
        super().__init__()

    def found(self, chunks: list[bytes]) -> tuple[list[int], list[int]]:
        merged = iter(self.merger.many([w for w in chunks if w not in self.entries]))
        each = [self.entries[w] if w in self.entries else next(merged) for w in chunks]
        return [i for ids in each for i in ids], list(map(len, each))


_coders: dict[str, WordIds] = {}
kept_by("byte_bpe", _coders.clear)
#: Words of a text whose ids are put together at once.
_STEP = 1 << 18


@worker("byte_bpe")
def _encoded(batches: Iterator[pa.RecordBatch], shared, digest: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Appends the ids of the last column, the text, in its place."""
    import regex

    if digest not in _coders:
        _coders.clear()
        ranks, entries = shared.value
        _coders[digest] = WordIds(ByteMerger(ranks), entries)
    coder, split = _coders[digest], regex.compile(pattern).findall
    for batch in batches:
        last = batch.num_columns - 1
        for lo, hi in slices(batch.column(last)):
            words: list[bytes] = []
            ends, parts = [0], []
            for text in texts_of(batch.column(last).slice(lo, hi - lo)):
                words += map(str.encode, split(text.decode()))
                ends.append(len(words))
            counts = [np.zeros(1, np.int64)]
            for at in range(0, len(words), _STEP):
                ids, offsets = coder.ids(words[at : at + _STEP])
                parts.append(ids)
                counts.append(offsets[1:] + counts[-1][-1])
            offsets = np.concatenate(counts)[ends].astype(np.int32)
            flat = pa.array(np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32))
            rest = [batch.column(i).slice(lo, hi - lo) for i in range(last)]
            yield pa.RecordBatch.from_arrays([*rest, pa.ListArray.from_arrays(pa.array(offsets), flat)], names=[*batch.schema.names[:last], "ids"])
    coder.shrink()


def encode(docs: DataFrame, vocabulary: Vocabulary, lexicon_size: int = LEXICON_SIZE, keep: list[str] | None = None) -> DataFrame:
    """`docs` (text, ...) with `ids`, the token ids of each text; `keep`: only these other columns."""
    entries = lexicon(docs, vocabulary, lexicon_size)
    # The vocabulary and at most lexicon_size short words.
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.ranks, entries))
    digest = hashlib.sha256(repr((sorted(vocabulary.ranks.items()), sorted(entries))).encode()).hexdigest()
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != "ids"]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").cast("string").alias(fresh(docs, "_text")))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return over_batches(rows, partial(_encoded, shared=shared, digest=digest, pattern=vocabulary.pattern), f"{ddl}{', ' if ddl else ''}ids array<int>")


def encode_by_fold(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The same as `encode`, every word of every text by the fold: built-in functions only."""
    words = F.transform(vocabulary.words(F.col("text")), lambda w: w.cast("binary"))
    return docs.withColumn("ids", F.flatten(F.transform(words, lambda w: folded(w, vocabulary))))


def decoded(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that an array of ids stands for (binary)."""
    pieces = F.transform(ids, lambda i: F.get(vocabulary.tokens, i).cast("string"))
    return F.array_join(pieces, "").cast("binary")
