"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary's trie gets a failure link and a popped-token count per node: when no edge
continues, the node's count says how many whole pieces the longest match leaves behind and
its link where the unmatched rest stands in the trie.  A word is read once, byte by byte,
and its piece count falls out without a piece being built.

Words are maximal runs outside space and 0x09-0x0D.  A word is matched as a space followed by
its bytes; vocabulary entries that begin with a space start a word, the others continue one.
A word that the vocabulary can't spell counts as one (unknown) piece.

The automaton is built on the driver from the vocabulary alone (a parameter file of fixed
size) and sent to the tasks; distinct words of a slice run through it together, and a worker
remembers the counts of a bounded number of words.  A word of `LONG_WORD` bytes or more goes
through the same automaton by itself, a byte a step.

Defined results: null text is empty: no words, no pieces; very long texts are read whole, in
parts cut between words, and a very long word costs a step per byte; repeated rows and null doc_ids are
counted each for itself; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculum.llm.bpe import _byte_letters
from vinculum.llm.common import SLICE_BYTES, over_batches, slices, stage, worker
from vinculum.llm.tokens import KEPT_CHUNKS, Interned, parts, texts_of

LONG_WORD = 48


def vocabulary(path: str) -> list[bytes]:
    """Byte strings of a byte-level vocabulary, without entries that hold a space inside."""
    byte_of = {c: b for b, c in ((ord(x), y) for x, y in _byte_letters().items())}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec["added_tokens"]}
    out = [bytes(byte_of.get(c, ord(c) & 255) for c in token) for token in spec["model"]["vocab"] if token not in special]
    return [t for t in out if t and b" " not in t[1:]]


class Automaton:
    def __init__(self, entries: Iterable[bytes]) -> None:
        edges: dict[int, int] = {}  # node * 256 + byte -> node
        whole, depth = {0: False}, [[0]]
        parent: list[int] = [0]  # key of the edge that leads to a node
        for entry in entries:
            node = 0
            for d, byte in enumerate(entry, 1):
                key = node * 256 + byte
                if key not in edges:
                    edges[key] = len(parent)
                    parent.append(key)
                    whole[edges[key]] = False
                    if len(depth) <= d:
                        depth.append([])
                    depth[d].append(edges[key])
                node = edges[key]
            whole[node] = True
        n = len(parent)
        link, popped = [-1] * n, [0] * n
        for level in depth[1:]:
            for node in level:
                if whole[node]:
                    link[node], popped[node] = 0, 1
                    continue
                up, byte = divmod(parent[node], 256)
                at, count = link[up], popped[up]
                while at >= 0 and at * 256 + byte not in edges:
                    at, count = link[at], count + popped[at]
                if at >= 0:
                    link[node], popped[node] = edges[at * 256 + byte], count
        rest = [0] * n  # pieces from a node back to the root, -1 where it can't get there
        for level in depth[1:]:
            for node in level:
                rest[node] = popped[node] + rest[link[node]] if link[node] >= 0 and rest[link[node]] >= 0 else -1
        order = sorted(edges)
        self.keys = np.array(order, np.int64)
        self.to = np.array([edges[k] for k in order], np.int64)
        self.link, self.popped, self.rest = np.array(link, np.int64), np.array(popped, np.int64), np.array(rest, np.int64)

    def _step(self, node: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = node * 256 + byte
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return self.keys[at] == key, self.to[at]

    def _read(self, table: np.ndarray, lens: np.ndarray) -> np.ndarray:
        node, count = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
        for t in range(table.shape[1]):
            rows = np.flatnonzero((lens > t) & (node >= 0))
            while len(rows):
                ok, to = self._step(node[rows], table[rows, t].astype(np.int64))
                node[rows[ok]] = to[ok]
                rows = rows[~ok]
                count[rows] += self.popped[node[rows]]
                node[rows] = self.link[node[rows]]
                rows = rows[node[rows] >= 0]
        tail = np.where(node >= 0, self.rest[np.maximum(node, 0)], -1)
        return np.where(tail >= 0, count + tail, 1)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word."""
        if not words or not len(self.keys):
            return np.ones(len(words), np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
        out = np.empty(len(words), np.int64)
        for r in np.flatnonzero(lens > LONG_WORD):
            out[r] = self._walk(b" " + words[r])
        rows = np.flatnonzero(lens <= LONG_WORD)
        if len(rows):
            width = int(lens[rows].max())
            table = np.frombuffer(b"".join((b" " + words[r]).ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
            out[rows] = self._read(table, lens[rows])
        return out

    @cached_property
    def _lists(self) -> tuple[dict[int, int], list[int], list[int]]:
        """Edges, links and popped counts for the walk of one word; made where one is met."""
        return dict(zip(self.keys.tolist(), self.to.tolist())), self.link.tolist(), self.popped.tolist()

    def _walk(self, word: bytes) -> int:
        """Pieces of one word.  Every failure pops pieces that bytes read before have pushed."""
        edges, link, popped = self._lists
        node = count = 0
        for byte in word:
            while (to := edges.get(node * 256 + byte)) is None:
                count += popped[node]
                node = link[node]
                if node < 0:
                    return 1
            node = to
        rest = int(self.rest[node])
        return count + rest if rest >= 0 else 1


@worker("wordpiece")
def _measured(batches: Iterator[pa.RecordBatch], automaton) -> Iterator[pa.RecordBatch]:
    read = automaton.value.counts
    known, pieces = Interned(), np.empty(0, np.int64)

    def total(text: bytes) -> tuple[int, int]:
        nonlocal known, pieces
        if len(known) > KEPT_CHUNKS:
            known, pieces = Interned(), np.empty(0, np.int64)
        words = text.split()
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        new, known.new = known.new, []
        if new:
            pieces = np.concatenate([pieces, read(new)])
        return len(words), int(pieces[at].sum())

    for batch in batches:
        for lo, hi in slices(batch.column(1)):
            texts = list(texts_of(batch.column(1).slice(lo, hi - lo)))
            if len(texts) == 1 and len(texts[0]) > 2 * SLICE_BYTES:
                sums = [tuple(map(sum, zip(*map(total, parts(texts[0])))))]
            else:  # the words of the slice are learned together
                total(b" ".join(texts))
                sums = list(map(total, texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array([w for w, _ in sums], pa.int64()), pa.array([n for _, n in sums], pa.int64())],
                names=["doc_id", "n_words", "n_pieces"],
            )


def token_counts(docs: DataFrame, entries: Iterable[bytes]) -> DataFrame:
    """doc_id, n_words, n_pieces: one row per row of `docs` (doc_id, text)."""
    automaton = docs.sparkSession.sparkContext.broadcast(Automaton(entries))  # bounded by the vocabulary
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(over_batches(rows, partial(_measured, automaton=automaton), "doc_id long, n_words long, n_pieces long"), "wordpiece-counts")
