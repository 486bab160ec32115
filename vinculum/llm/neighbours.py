"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

1. *Index.* Each of `tables` pseudo-random rotations (three rounds of random signs and a fast
   Hadamard transform) turns a unit vector; its bucket is the signed axis nearest to it.
   Every row is indexed in every table.
2. *Probe.* A query looks into the `probes` nearest signed axes of each table.
3. *Rerank.* Buckets are dealt in blocks of about `block_rows` vectors, counted first; a
   query visits every block of the buckets it probes.  A task holds one block, streams the
   queries past it and writes the k best different vec_ids per query and block, each by its
   best row, scored by the exact cosine in double precision on the original vectors.  Equal
   rows of one vec_id are indexed once.
4. The best k different neighbours of each query come from at most tables x probes x blocks
   short lists.  No candidate pair is ever written.
5. *Complete.* Queries for which the tables found fewer than k pass by all rows of their width,
   dealt in blocks likewise, so they get the exact nearest; so few are in reach of a query only
   where a width has few rows or its rows lie in few buckets.

A table's parameters don't depend on the data; nothing is fitted.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component,
and rows without vec_id, take no part; only vectors of equal length are compared; rows that
share a vec_id are one candidate (its best row) and one query (best over its rows), and never
neighbours of themselves; ties of score go to the smaller vec_id; a query gets fewer
than k only where fewer rows can be compared with it; extra columns are not read; an empty table
gives an empty result.  Vectors of any finite size are compared: each is scaled by a power of
two first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vinculum.llm.common import over_batches, stage, worker


@dataclass(frozen=True)
class Params:
    k: int = 5
    tables: int = 12
    probes: int = 6
    block_rows: int = 4096
    seed: int = 977


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x


def rotated(x: np.ndarray, table: int, p: Params) -> np.ndarray:
    """Rows of `x`, padded to a power of two, under the table's pseudo-rotation."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    for signs in np.random.Generator(np.random.PCG64([p.seed, table])).integers(0, 2, (3, width)) * 2 - 1:
        x = _hadamard(x * signs)
    return x


def nearest_axes(x: np.ndarray, table: int, count: int, p: Params) -> np.ndarray:
    """The `count` nearest signed axes of each row, nearest first: axis, or axis + width if negative."""
    y = rotated(x, table, p)
    y = np.concatenate([y, -y], axis=1)
    return np.argsort(-y, axis=1, kind="stable")[:, : min(count, y.shape[1])]


def _vectors(column: pa.Array) -> list[np.ndarray]:
    values, offsets = column.flatten(), column.offsets.to_numpy() - column.offsets[0].as_py()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _by_width(vectors: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    widths = np.array([len(v) for v in vectors])
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield rows, np.vstack([vectors[r] for r in rows])


@worker("neighbours")
def _hashed(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    """Adds per row its bucket of each table, and the buckets it probes as a query."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 2048):
            batch = whole.slice(lo, 2048)
            vectors = _vectors(pa.concat_arrays([batch.column(1)]))
            own: list[list[int]] = [[] for _ in vectors]
            probed: list[list[int]] = [[] for _ in vectors]
            for rows, x in _by_width(vectors):
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for t in range(p.tables):
                    axes = nearest_axes(x, t, p.probes, p)
                    for r, found in zip(rows.tolist(), axes.tolist()):
                        own[r].append(found[0])
                        probed[r].append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int32())), pa.array(probed, pa.list_(pa.list_(pa.int32())))],
                names=["vec_id", "embedding", "own", "probed"],
            )


def scaled(x: np.ndarray) -> np.ndarray:
    """Each vector (last axis) times a power of two that brings its largest component near 1.

    This is exact and changes no cosine but for squares that would overflow or vanish.
    """
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True, initial=0.0))[1])


def cosines(block: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query (both `scaled`); equal rows get equal values."""
    return (block * query).sum(axis=1) / (np.sqrt((block * block).sum(axis=1)) * np.sqrt((query * query).sum()))


def _by_id(ids: list[int], rows: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different ids of a block in order, where the rows of each start, and the rows in that order."""
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, width))
    order = np.argsort(np.array(ids, np.int64), kind="stable")
    different, starts = np.unique(np.array(ids, np.int64)[order], return_index=True)
    return different, starts, scaled(np.vstack(rows)[order])


def best_of_block(block: tuple[np.ndarray, np.ndarray, np.ndarray], vec_id: int, vector: np.ndarray, k: int) -> list[tuple[int, float]]:
    """The k best other ids of a block with the score of their best rows, best first."""
    ids, starts, rows = block
    if not len(ids):
        return []
    score = cosines(rows, scaled(vector))
    score[~np.isfinite(score)] = -np.inf
    score = np.maximum.reduceat(score, starts)  # one score per id, so the cut below counts ids
    score[ids == vec_id] = -np.inf
    if len(score) > k:
        top = np.flatnonzero(score >= np.partition(score, -k)[-k])
    else:
        top = np.arange(len(score))
    top = top[np.lexsort((ids[top], -score[top]))][:k]
    return [(int(ids[i]), float(score[i])) for i in top if score[i] != -np.inf]


@worker("neighbours")
def _reranked(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (block key, side): the block's vectors, then its queries."""
    group, ids, rows, block = None, [], [], None
    for batch in batches:
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
        sides, vec_ids, vectors = batch.column(4).to_pylist(), batch.column(5).to_pylist(), _vectors(pa.concat_arrays([batch.column(6)]))
        found: list[tuple[int, int, float]] = []
        for key, side, vec_id, vector in zip(keys, sides, vec_ids, vectors):
            if key != group:
                group, ids, rows, block = key, [], [], None
            if side == 0:
                ids.append(vec_id)
                rows.append(vector)
                continue
            if block is None:
                block = _by_id(ids, rows, len(vector))
            found += [(vec_id, other, score) for other, score in best_of_block(block, vec_id, vector, p.k)]
        if found:
            a, b, c = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], names=["query_id", "vec_id", "score"])


def _against_all(rows: DataFrame, queries: DataFrame, p: Params) -> DataFrame:
    """The k best of every block of the rows of a query's width: query_id, vec_id, score."""
    widths = queries.select("width").distinct()
    blocks = stage(rows.join(widths, "width", "left_semi").groupBy("width").agg(F.ceil(F.count("*") / p.block_rows).cast("int").alias("blocks")), "neighbour-widths")
    whole = [F.lit(-1).alias("table"), F.lit(0).alias("bucket")]
    stored = rows.join(blocks, "width").select("width", *whole, F.pmod(F.xxhash64("vec_id", "embedding"), "blocks").cast("int").alias("block"), F.lit(0).alias("side"), "vec_id", "embedding")
    asking = queries.join(blocks, "width").select("width", *whole, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), "vec_id", "embedding")
    dealt = stored.unionByName(asking).repartition("width", "block").sortWithinPartitions("width", "table", "bucket", "block", "side")
    return stage(over_batches(dealt, partial(_reranked, p=p), "query_id long, vec_id long, score double"), "neighbour-completed")


def nearest(vectors: DataFrame, is_query, params: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row where `is_query` holds."""
    p = params
    x = F.col("embedding")
    whole = F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    # Equal rows of one vec_id are one row: copies would all meet in one block.
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).filter(whole).distinct()
    hashed = over_batches(rows, partial(_hashed, p=p), "vec_id long, embedding array<double>, own array<int>, probed array<array<int>>")
    hashed = stage(hashed.withColumn("width", F.size("embedding")), "neighbour-keys")
    indexed = hashed.select("width", F.posexplode("own").alias("table", "bucket"), "vec_id", "embedding")
    probing = (
        hashed.filter(is_query)
        .select("width", F.posexplode("probed").alias("table", "buckets"), "vec_id", "embedding")
        .select("width", "table", F.explode("buckets").alias("bucket"), "vec_id", "embedding")
    )
    # One row per bucket: at most tables x 2 axes of a width.
    blocks = stage(indexed.groupBy("width", "table", "bucket").agg(F.ceil(F.count("*") / p.block_rows).cast("int").alias("blocks")), "neighbour-blocks")
    key = ["width", "table", "bucket"]
    columns = [*key, "block", "side", "vec_id", "embedding"]
    stored = indexed.join(blocks, key).withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), "blocks").cast("int")).withColumn("side", F.lit(0))
    asking = probing.join(blocks, key).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(1))
    dealt = stored.select(columns).unionByName(asking.select(columns)).repartition(*key, "block").sortWithinPartitions(*key, "block", "side")
    found = over_batches(dealt, partial(_reranked, p=p), "query_id long, vec_id long, score double")
    found = stage(found, "neighbour-found")

    enough = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).filter(F.col("n") >= p.k).select(F.col("query_id").alias("vec_id"))
    short = stage(hashed.filter(is_query).join(enough, "vec_id", "left_anti").select("width", "vec_id", "embedding"), "neighbour-short")
    if not short.isEmpty():
        found = found.unionByName(_against_all(hashed.select("width", "vec_id", "embedding"), short, p))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k per probed block
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
