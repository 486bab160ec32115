"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Built-in functions only.  Rows are numbered 0..n-1 in an order that depends on their content
alone (a hash of doc_id, text checksum and size, then these values), not on files or
partitions: hash buckets are counted, offsets are running sums over the bucket counts, and
the rest is a row number within the bucket.  A Feistel network over a grid of width x height
cells (the smallest near-square grid that holds n) permutes the numbers; numbers that land
outside 0..n-1 walk on along their cycle until they return.  Position p then lies in shard
p % shards at slot p // shards, so shard sizes differ by at most one (law `rows`) and slots
are gapless.  `locate` computes the same for one number without Spark.

Defined results: null texts count as no bytes (size 8, checksum 0); null doc_ids are numbered
like others; wholly equal rows are interchangeable; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vinculum.llm.common import stage

ROUNDS = 6
SEED = 20240229
#: Bytes a row counts besides its text.
ROW_BYTES = 8
#: Rows that a numbering bucket holds on average.
BUCKET_ROWS = 8192


def grid(n: int) -> tuple[int, int]:
    """Width and height of the smallest near-square grid with at least n cells."""
    width = math.isqrt(max(0, n - 1)) + 1
    return width, max(1, -(-n // width))


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _turned(x: Column, n: int, seed: int) -> Column:
    """One application of the network: even rounds move the row of the grid, odd ones the column."""
    width, height = grid(n)

    def turn(cell: Column, k: Column) -> Column:
        a, b = cell["a"], cell["b"]
        move = F.xxhash64(F.when(F.pmod(k, F.lit(2)) == 0, b).otherwise(a), k, _long(seed))
        even = F.struct(F.pmod(a + F.pmod(move, _long(width)), _long(width)).alias("a"), b.alias("b"))
        odd = F.struct(a.alias("a"), F.pmod(b + F.pmod(move, _long(height)), _long(height)).alias("b"))
        return F.when(F.pmod(k, F.lit(2)) == 0, even).otherwise(odd)

    start = F.struct(F.call_function("div", x, _long(height)).alias("a"), F.pmod(x, _long(height)).alias("b"))
    rounds = F.array(*[_long(i) for i in range(ROUNDS)])
    return F.aggregate(rounds, start, turn, lambda cell: cell["a"] * _long(height) + cell["b"])


def shuffled(rows: DataFrame, number: str, n: int, into: str, seed: int = SEED) -> DataFrame:
    """`rows` with column `into`: the place (0..n-1) of row `number` in the shuffled order."""
    width, height = grid(n)
    rows = rows.withColumn(into, _turned(F.col(number), n, seed))
    outside = width * height - n  # a walk meets each of these cells once at most
    if not outside:
        return rows
    steps = F.sequence(_long(1), _long(outside))
    walked = F.aggregate(steps, F.col(into), lambda p, _: F.when(p < _long(n), p).otherwise(_turned(p, n, seed)))
    return rows.withColumn(into, F.when(F.col(into) < _long(n), F.col(into)).otherwise(walked))


def locate(number: int, n: int, shards: int, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of one row number; the same arithmetic outside Spark."""
    import struct

    import xxhash

    def keyed(*values: int) -> int:
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
        return h - (1 << 64) if h >> 63 else h

    width, height = grid(n)
    p = number
    while True:
        a, b = divmod(p, height)
        for k in range(ROUNDS):
            if k % 2 == 0:
                a = (a + keyed(b, k, seed) % width) % width
            else:
                b = (b + keyed(a, k, seed) % height) % height
        p = a * height + b
        if p < n:
            return p % shards, p // shards


def numbered(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """`rows` with `row_number` 0..n-1, an order that depends on the values of `keys` alone."""
    buckets = max(1, -(-n // BUCKET_ROWS))
    rows = rows.withColumn("_hash", F.xxhash64(*keys)).withColumn("_bucket", F.pmod(F.col("_hash"), _long(buckets)))
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), _long(0)).alias("_before"))
    inside = Window.partitionBy("_bucket").orderBy("_hash", *keys)
    return rows.withColumn("_at", F.row_number().over(inside)).join(offsets, "_bucket").withColumn("row_number", F.col("_before") + F.col("_at") - 1).drop("_hash", "_bucket", "_at", "_before")


def shards(docs: DataFrame, count: int = 24, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number per row of `docs`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    slim = stage(slim, "shard-rows")
    n = slim.count()
    placed = shuffled(numbered(slim, ["doc_id", "text_crc32", "size"], n), "row_number", n, "_place", seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod(F.col("_place"), _long(count)).cast("int").alias("shard"),
        F.call_function("div", F.col("_place"), _long(count)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
