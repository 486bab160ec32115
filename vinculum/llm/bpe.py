"""Byte-pair encoding and decoding with a minimal acyclic transducer as lexicon.

1. Chunk frequencies are counted over the whole corpus; the `lexicon_size` most frequent
   chunks, a bounded number, are encoded and compiled on the driver into a minimal acyclic
   automaton (states with equal futures are shared).  Each edge carries how many entries
   sort before those it leads to; summed along a path, that is the entry's number, the key to
   its ids.  Automaton and ids are one array of integers, sent as bytes.
2. Each Python worker writes the array once to its own temp folder and memory-maps it, so
   workers of a machine share its pages.  Distinct chunks of a slice run through the
   automaton together, byte by byte.
3. Chunks that are not entries are merged exactly: special tokens, normalisation and
   pre-tokenisation as the tokenizer defines them, then lowest-ranked merge first, leftmost
   of equals; long words use a heap.

Decoding joins the ids' tokens by one space, as the library does for a tokenizer without a
decoder.

Defined results: null text is empty: no ids, digests of the empty string; repeated rows and
null doc_ids are encoded each for itself; extra columns are not read; an empty table gives an
empty result (and an empty lexicon).
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculum.llm.common import SLICE_BYTES, kept_by, over_batches, slices, stage, worker
from vinculum.llm.tokens import PIECE, ChunkIds, chunks, parts, texts_of, tokenizer

LEXICON_SIZE = 40_000
#: Longest entry in bytes.
ENTRY_BYTES = 32
#: Distinct chunks a counting task holds before it hands on partial counts.
COUNTED_CHUNKS = 200_000
#: Words of one of these ranges of length are merged together; longer ones each with a heap.
WORD_WIDTHS = (0, 5, 8, 12, 20, 40)

_WORD_END = "</w>"


# --- exact merging -----------------------------------------------------------------------


class Merger:
    """Ids of any chunk by the tokenizer's own rules and merge ranks."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.is_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.library = tokenizer(path)
        self.tokens = {i: t for t, i in {**self.vocab, **self.special}.items()}
        # The merges as arrays: pair keys in order, rank of each, merged id of each rank.
        keys = np.array([a << 20 | b for a, b in self.merges], np.int64)
        ranks = np.array([r for r, _ in self.merges.values()], np.int32)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], ranks[order]
        self.none = np.int32(ranks.max() + 1)
        self.made = np.zeros(int(self.none), np.int32)
        self.made[ranks] = [i for _, i in self.merges.values()]
        letters = [*map(chr, range(512))]
        self.inner = np.array([self.vocab.get(c, -1) for c in letters], np.int32)
        self.last = np.array([self.vocab.get(c + _WORD_END, -1) for c in letters], np.int32)

    def pieces(self, chunk: bytes) -> list[str | int]:
        """Words of byte-level letters, and ids of special tokens, in order."""
        text = chunk.decode()
        if text.isascii() and text.isalpha() and text.islower():
            return [text]
        out: list[str | int] = []
        for segment in self.is_special.split(text) if self.is_special and "<|" in text else (text,):
            if segment in self.special:
                out.append(self.special[segment])
            elif segment.isascii():
                found = PIECE.findall(segment.lower())
                out += found if segment.isprintable() else ["".join(_byte_letters().get(c, c) for c in p) for p in found]
            else:
                out += [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(segment))]
        return out

    def ids(self, chunk: bytes) -> list[int]:
        return self.many([chunk])[0]

    def many(self, chunks: list[bytes]) -> list[list[int]]:
        """Ids of each chunk; all their different words are merged together."""
        of_chunk = list(map(self.pieces, chunks))
        words = list(dict.fromkeys(p for pieces in of_chunk for p in pieces if not isinstance(p, int)))
        merged = dict(zip(words, self._merged(words)))
        return [[i for p in pieces for i in ((p,) if isinstance(p, int) else merged[p])] for pieces in of_chunk]

    def _merged(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in zip(WORD_WIDTHS[:-1], WORD_WIDTHS[1:]):
            rows = np.flatnonzero((lens > low) & (lens <= high))
            for lo in range(0, len(rows), 8192):
                part = rows[lo : lo + 8192]
                for r, ids in zip(part.tolist(), self._merged_together([words[r] for r in part.tolist()], lens[part])):
                    out[r] = ids
        for r in np.flatnonzero(lens > WORD_WIDTHS[-1]).tolist():
            out[r] = self._merged_by_heap([*map(int, self.inner[[ord(c) for c in words[r][:-1]]]), int(self.last[ord(words[r][-1])])])
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == key) & (right >= 0), self.ranks[at], self.none)

    def _merged_together(self, words: list[str], lens: np.ndarray) -> list[list[int]]:
        """Words of like length, one merge each per round: the lowest rank, leftmost of equals.

        A round shortens every unfinished word by one symbol and looks up only the two pairs
        beside the merge.
        """
        width = int(lens.max())
        letters = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-16-le"), np.uint16).reshape(len(words), width)
        columns = np.arange(width)
        s = np.where(columns < lens[:, None] - 1, self.inner[letters], np.where(columns == lens[:, None] - 1, self.last[letters], -1))
        out: list[list[int]] = [[]] * len(words)
        rows = np.arange(len(words))
        rank = self._rank(s[:, :-1], s[:, 1:]) if width > 1 else np.full((len(words), 1), self.none)
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            done = best == self.none
            for r, symbols in zip(rows[done].tolist(), s[done].tolist()):
                out[r] = symbols[: symbols.index(-1)] if symbols[-1] == -1 else symbols
            more = ~done
            rows, s, rank, at, best = rows[more], s[more], rank[more], at[more], best[more]
            if not len(rows):
                break
            each = np.arange(len(rows))
            s[each, at] = self.made[best]
            keep = np.arange(s.shape[1] - 1)
            s = np.take_along_axis(s, keep + (keep > at[:, None]), axis=1)
            if rank.shape[1] == 1:
                rank = np.full((len(rows), 1), self.none)
                continue
            keep = keep[:-1]
            rank = np.take_along_axis(rank, keep + (keep >= at[:, None]), axis=1)
            left, right = at > 0, at < rank.shape[1]
            rank[each[left], at[left] - 1] = self._rank(s[each[left], at[left] - 1], s[each[left], at[left]])
            rank[each[right], at[right]] = self._rank(s[each[right], at[right]], s[each[right], at[right] + 1])
        return out

    def _merged_by_heap(self, s: list[int]) -> list[int]:
        n = len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, s[i], s[i + 1]) for i in range(n - 1) if (m := self.merges.get((s[i], s[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if s[i] != a or j >= n or s[j] != b:
                continue
            s[i], s[j] = self.merges[a, b][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (m := self.merges.get((s[left], s[right]))):
                    heapq.heappush(heap, (m[0], left, s[left], s[right]))
        return [x for x in s if x >= 0]


@functools.lru_cache(maxsize=1)
def _byte_letters() -> dict[str, str]:
    """Byte-level letters: printable Latin-1 bytes stand for themselves, the others, in order,
    for the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): chr(256 + i) for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


# --- lexicon -----------------------------------------------------------------------------


def compile_lexicon(entries: dict[bytes, list[int]]) -> np.ndarray:
    """One int32 array: seven lengths, then edge keys (state * 256 + byte, ascending), edge
    targets, edge counts, final flags, id offsets and ids of the entries in byte order."""
    edges: list[list[tuple[int, int]]] = [[]]  # of each state, by ascending byte
    final: list[bool] = [False]
    register: dict[tuple, int] = {}
    path: list[int] = [0]  # states of the previous entry

    def share(down_to: int, word: bytes) -> None:
        while len(path) > down_to + 1:
            state = path.pop()
            key = (final[state], tuple(edges[state]))
            known = register.setdefault(key, state)
            if known != state:
                parent = path[-1]
                edges[parent][-1] = (word[len(path) - 1], known)

    words = sorted(w for w in entries if w)
    last = b""
    for word in words:
        common = len(os.path.commonprefix([last, word]))
        share(common, last)
        for byte in word[common:]:
            edges.append([])
            final.append(False)
            edges[path[-1]].append((byte, len(edges) - 1))
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = word
    share(0, last)

    number: dict[int, int] = {0: 0}  # states reachable, in breadth-first order
    queue = [0]
    for state in queue:
        for _, to in edges[state]:
            if to not in number:
                number[to] = len(queue)
                queue.append(to)
    below: dict[int, int] = {}  # entries accepted from a state
    stack = [0]
    while stack:
        state = stack[-1]
        todo = [to for _, to in edges[state] if to not in below]
        if todo:
            stack += todo
        else:
            below[stack.pop()] = final[state] + sum(below[to] for _, to in edges[state])
    keys, targets, counts = [], [], []
    for state in queue:
        before = int(final[state])
        for byte, to in edges[state]:
            keys.append(number[state] * 256 + byte)
            targets.append(number[to])
            counts.append(before)
            before += below[to]
    ids = [entries[w] for w in words]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    sections = [keys, targets, counts, [final[s] for s in queue], offsets, [i for x in ids for i in x], [max(map(len, words), default=0)]]
    sections = [np.asarray(x, np.int32) for x in sections]
    return np.concatenate([np.array([len(x) for x in sections], np.int32), *sections])


class Lexicon:
    def __init__(self, array: np.ndarray) -> None:
        at, self.sections = 7, []
        for n in array[:7].tolist():
            self.sections.append(array[at : at + n])
            at += n
        self.keys, self.to, self.before, self.final, self.offsets, self.ids, longest = self.sections
        self.longest = int(longest[0])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Entry numbers of the words, -1 for those that are no entries."""
        n = len(words)
        lens = np.fromiter(map(len, words), np.int64, n)
        out = np.full(n, -1, np.int64)
        rows = np.flatnonzero((lens > 0) & (lens <= self.longest))
        if not len(rows) or not len(self.keys):
            return out
        width = int(lens[rows].max())
        table = np.frombuffer(b"".join(words[r].ljust(width, b"\0") for r in rows.tolist()), np.uint8).reshape(len(rows), width)
        state, number, lens = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), lens[rows]
        alive = np.arange(len(rows))
        for t in range(width):
            done = alive[lens[alive] == t]
            hit = done[self.final[state[done]] == 1]
            out[rows[hit]] = number[hit]
            alive = alive[lens[alive] > t]
            key = (state[alive] * 256 + table[alive, t]).astype(np.int32)
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            ok = self.keys[at] == key
            alive, at = alive[ok], at[ok]
            number[alive] += self.before[at]
            state[alive] = self.to[at]
        hit = alive[self.final[state[alive]] == 1]
        out[rows[hit]] = number[hit]
        return out

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.offsets[number] : self.offsets[number + 1]].tolist()


@functools.lru_cache(maxsize=2)
def _mapped(digest: str, load) -> Lexicon:
    path = os.path.join(tempfile.gettempdir(), f"lexicon-{digest}.npy")
    if not os.path.exists(path):
        handle, part = tempfile.mkstemp(dir=tempfile.gettempdir())
        with os.fdopen(handle, "wb") as f:
            f.write(load())
        os.replace(part, path)
    return Lexicon(np.memmap(path, np.int32, "r"))


class _Loader:
    """Bytes of a broadcast value; equal for equal digests, so a worker maps them once."""

    def __init__(self, broadcast) -> None:
        self.broadcast = broadcast

    def __call__(self) -> bytes:
        return self.broadcast.value

    def __hash__(self) -> int:
        return 0

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Loader)


# --- Spark jobs --------------------------------------------------------------------------


@worker("bpe")
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["chunk", "n"])
        counts.clear()
        return batch

    for batch in batches:
        for lo, hi in slices(batch.column(0)):
            for text in texts_of(batch.column(0).slice(lo, hi - lo)):
                for part in (text,) if len(text) <= 2 * SLICE_BYTES else parts(text):
                    counts.update(chunks(part))
            if len(counts) > COUNTED_CHUNKS:
                yield out()
    yield out()


def frequent_chunks(docs: DataFrame, n: int) -> list[bytes]:
    """At most n chunks: all that occur at least as often as the rarest of them.

    The least count comes from the number of chunks per count, a small table; so no task and
    not the driver ever sorts or holds more than the n short values that are collected.
    """
    rows = over_batches(docs.select(F.col("text").cast("string").alias("text")), _counted, "chunk binary, n long")
    counts = stage(rows.filter(F.octet_length("chunk") <= ENTRY_BYTES).groupBy("chunk").agg(F.sum("n").alias("n")).filter("n > 1"), "bpe-counts")
    # Counts from `exact` on share a cell per power of two, which bounds the table.
    exact = 4096
    cell = F.when(F.col("n") < exact, F.col("n")).otherwise(F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("long"))
    least, taken = None, 0
    for row in sorted(counts.groupBy(cell.alias("n")).agg(F.count("*").alias("chunks")).collect(), reverse=True):
        if taken + row["chunks"] > n:
            break
        least, taken = row["n"], taken + row["chunks"]
    if least is None:
        return []
    return [bytes(r["chunk"]) for r in counts.filter(F.col("n") >= least).select("chunk").collect()]


class LexiconIds(ChunkIds):
    """Ids of chunks: an entry's from the lexicon, other chunks' by merging."""

    def __init__(self, path: str, lexicon: Lexicon) -> None:
        self.merger, self.lexicon = merger(path), lexicon
        n = max(self.merger.tokens) + 1
        self.numbers = TextTable([str(i) for i in range(n)])
        self.tokens = TextTable([self.merger.tokens.get(i, "") for i in range(n)])
        super().__init__()

    def found(self, chunks: list[bytes]) -> tuple[list[int], list[int]]:
        numbers = self.lexicon.numbers(chunks).tolist()
        merged = iter(self.merger.many([c for c, number in zip(chunks, numbers) if number < 0]))
        ids: list[int] = []
        counts = []
        for number in numbers:
            of = self.lexicon.ids_of(number) if number >= 0 else next(merged)
            ids += of
            counts.append(len(of))
        return ids, counts


class TextTable:
    """UTF-8 text of each id with a space behind it, joined for many ids at a time."""

    def __init__(self, texts: list[str]) -> None:
        data = [t.encode() + b" " for t in texts]
        self.lens = np.fromiter(map(len, data), np.int64, len(data))
        self.starts = np.cumsum(self.lens) - self.lens
        self.flat = np.frombuffer(b"".join(data), np.uint8)

    def digests(self, ids: np.ndarray, borders: list[int], hashes: list) -> None:
        """Feeds the texts of ids[borders[i]:borders[i+1]], joined by spaces and with one behind,
        to hashes[i]."""
        lens = self.lens[ids]
        ends = np.concatenate([[0], np.cumsum(lens)])
        text = self.flat[np.repeat(self.starts[ids] - ends[:-1], lens) + np.arange(ends[-1])]
        cuts = ends[borders].tolist()
        for h, lo, hi in zip(hashes, cuts[:-1], cuts[1:]):
            h.feed(text[lo:hi])


class _Joined:
    """SHA-256 of texts joined by spaces; the space behind the last one is held back."""

    def __init__(self) -> None:
        self.hash, self.open = hashlib.sha256(), False

    def feed(self, text: np.ndarray) -> None:
        if len(text):
            if self.open:
                self.hash.update(b" ")
            self.hash.update(text[:-1])
            self.open = True


_encoders: dict[tuple[str, str], LexiconIds] = {}
kept_by("bpe", _encoders.clear)
kept_by("bpe", merger.cache_clear)
kept_by("bpe", _mapped.cache_clear)


@worker("bpe")
def _encoded(batches: Iterator[pa.RecordBatch], path: str, digest: str, load: _Loader) -> Iterator[pa.RecordBatch]:
    if (path, digest) not in _encoders:
        _encoders.clear()
        _encoders[path, digest] = LexiconIds(path, _mapped(digest, load))
    coder = _encoders[path, digest]
    for batch in batches:
        for lo, hi in slices(batch.column(1)):
            texts = list(texts_of(batch.column(1).slice(lo, hi - lo)))
            n_tokens = [0] * len(texts)
            id_hashes, text_hashes = [_Joined() for _ in texts], [_Joined() for _ in texts]
            # One step for the slice, or one for each part of a very long text.
            steps = [texts] if len(texts) > 1 or len(texts[0]) <= 2 * SLICE_BYTES else [[p] for p in parts(texts[0])]
            for step in steps:
                words: list[bytes] = []
                ends = [0]
                for text in step:
                    words += chunks(text)
                    ends.append(len(words))
                ids, offsets = coder.ids(words)
                borders = offsets[ends].tolist()
                for i, (a, b) in enumerate(zip(borders[:-1], borders[1:])):
                    n_tokens[i] += b - a
                coder.numbers.digests(ids, borders, id_hashes)
                coder.tokens.digests(ids, borders, text_hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(n_tokens, pa.int64()), pa.array([h.hash.hexdigest() for h in id_hashes]), pa.array([h.hash.hexdigest() for h in text_hashes])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
    coder.shrink()


def encode(docs: DataFrame, tokenizer_path: str, lexicon_size: int = LEXICON_SIZE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: one row per row of `docs` (doc_id, text)."""
    exact = merger(tokenizer_path)
    entries = frequent_chunks(docs, lexicon_size)
    array = compile_lexicon(dict(zip(entries, exact.many(entries))))
    data = array.tobytes()
    load = _Loader(docs.sparkSession.sparkContext.broadcast(data))  # at most lexicon_size short entries
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    step = partial(_encoded, path=tokenizer_path, digest=hashlib.sha256(data).hexdigest()[:24], load=load)
    return stage(over_batches(rows, step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"), "bpe-encoded")
