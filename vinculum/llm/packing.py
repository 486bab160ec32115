"""Best-fit decreasing packing of tokenized documents into sequences of bounded length.

1. One Arrow pass turns each document into its ids and a closing id, cut into pieces of at
   most `length` only where it is longer.  The piece table is staged.
2. Pieces are dealt by hash into groups of about `group_pieces`, as many groups as the table
   needs; each group has nearly the length mix of the whole, so packing groups apart costs
   about one sequence per group.
3. Each group is packed by best-fit decreasing: pieces from long to short, each into the open
   sequence with the least room that still holds it.  Open sequences hang in stacks under
   the leaves of a segment tree over remaining room; the tree finds the tightest stack in
   a logarithmic number of steps per piece.
4. Sequences that stay under `repack_below` full are few; their pieces are dealt into new
   groups across the old ones and packed again.

Defined results: null text is empty (one piece, the closing id); a null doc_id is packed like
any other; repeated rows give repeated pieces; ties of length go by id, piece and row; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculum.llm.common import kept_by, over_batches, slices, stage, worker
from vinculum.llm.tokens import chunk_ids, text_ids

kept_by("packing", chunk_ids.cache_clear)


@dataclass(frozen=True)
class Params:
    length: int = 2048
    closing_id: int = 0
    group_pieces: int = 16384
    repack_below: float = 0.97


@worker("packing")
def _cut(batches: Iterator[pa.RecordBatch], path: str, p: Params) -> Iterator[pa.RecordBatch]:
    table = chunk_ids(path)
    for batch in batches:
        ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
        for lo, hi in slices(texts):
            out: list[tuple] = []
            for r, ids in enumerate(text_ids(texts.slice(lo, hi - lo), table)):
                ids = np.append(ids, np.uint32(p.closing_id)).astype("<u4")
                for piece, at in enumerate(range(0, len(ids), p.length)):
                    part = ids[at : at + p.length]
                    out.append((ids_of[lo + r], piece, at, len(part), zlib.crc32(part.tobytes())))
            doc, piece, start, length, crc = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
    table.shrink()


class RoomTree:
    """Segment tree over remaining room 0..capacity; a leaf's stack holds open sequences."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)  # open sequences below each node
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]

    def push(self, room: int, sequence: int) -> None:
        self.stacks[room].append(sequence)
        i = room + self.size
        while i:
            self.open[i] += 1
            i >>= 1

    def pop(self, least: int) -> tuple[int, int] | None:
        """Takes out a sequence with the smallest room >= least: (room, sequence)."""
        i = least + self.size
        if not self.open[i]:
            while i > 1 and (i & 1 or not self.open[i + 1]):  # up to a filled right sibling
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:  # and down to its leftmost filled leaf
                i = 2 * i if self.open[2 * i] else 2 * i + 1
        room = i - self.size
        while i:
            self.open[i] -= 1
            i >>= 1
        return room, self.stacks[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) for each of `lengths`, which are sorted from long to short."""
    tree, used, placed = RoomTree(capacity), 0, []
    for n in lengths:
        found = tree.pop(n)
        if found is None:
            found = (capacity, used)
            used += 1
        room, sequence = found
        placed.append((sequence, capacity - room))
        if room > n:
            tree.push(room - n, sequence)
    return placed


@worker("packing")
def _packed(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by group, and in a group from long to short."""
    chunk_ids.cache_clear()  # of the cutting tasks; not needed here
    group, held = -1, []

    def packed() -> pa.RecordBatch:
        lengths = np.concatenate([b.column("length").to_numpy() for b in held])
        placed = np.array(best_fit_decreasing(lengths.tolist(), p.length), np.int64)
        sequence = placed[:, 0]
        full = np.bincount(sequence, weights=lengths)
        rows = pa.Table.from_batches(held).combine_chunks()
        columns = [rows.column(name).combine_chunks() for name in rows.column_names]
        columns += [pa.array((group << 32) + sequence), pa.array(placed[:, 1]), pa.array(full[sequence] / p.length)]
        return pa.RecordBatch.from_arrays(columns, names=[*rows.column_names, "sequence_id", "offset", "filled"])

    for batch in batches:
        groups = batch.column("group").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi > lo and groups[lo] != group:
                if held:
                    yield packed()
                group, held = int(groups[lo]), []
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield packed()


def _dealt(pieces: DataFrame, p: Params, first_group: int) -> DataFrame:
    """`pieces` packed group by group, with sequence_id, offset and filled."""
    groups = max(1, -(-pieces.count() // p.group_pieces))
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "row", F.lit(first_group)), F.lit(groups)) + first_group
    rows = pieces.withColumn("group", key.cast("long")).repartition("group")
    rows = rows.sortWithinPartitions("group", F.desc("length"), "doc_id", "piece", "row")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return over_batches(rows, partial(_packed, p=p), f"{ddl}, sequence_id long, offset long, filled double")


def pack(docs: DataFrame, tokenizer_path: str, params: Params = Params()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    p = params
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = over_batches(rows, partial(_cut, path=tokenizer_path, p=p), "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = stage(pieces.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    names = pieces.columns
    first = stage(_dealt(pieces, p, 0), "pack-first")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    loose = first.filter(F.col("filled") < p.repack_below).select(names)
    again = _dealt(loose, p, 1 << 30)
    return first.filter(F.col("filled") >= p.repack_below).select(columns).unionByName(again.select(columns))
