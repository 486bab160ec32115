"""MinHash near-duplicates with sequential Bayesian verification.

Method, as Spark jobs over whole texts:

1. *Sign.* One Arrow pass turns each text into its distinct word shingles (64-bit hashes of
   all words), a 128-bit key of the whole set, and one 64-bit key per band of the min-hash
   signature.  Rows with equal keys are one class, represented by its smallest doc_id.
2. *Band.* A bucket is a band key shared by at least two different classes.  Every member
   is tied to the bucket's smallest member, its hub; connected ties form candidate clusters.
   No pair within a bucket is written.
3. *Verify.* Each cluster is dealt out in blocks of bounded size and every pair of blocks
   goes to a task.  For pairs that share a band the task compares the signatures batch by
   batch and drops a pair as soon as the posterior probability (uniform prior, binomial
   matches) that its similarity reaches the threshold falls under `miss`.  Survivors not
   yet connected are verified on the full sets; the task writes only links that join two
   of its components, so its output is linear in its input.
4. *Connect.* Components over the verified links give the smallest reachable doc_id.

Band rows and count follow from the threshold so that a linked pair shares no band with
chance at most `band_miss`.  There is no cap on buckets, candidates or partners.

Defined results: null or word-less texts have an empty set and are linked with nothing; rows
with a null doc_id are linked with nothing and keep a null component; rows that repeat a
doc_id are one node: all its texts have one component, and `keep_one` keeps or drops them
together; extra columns pass through `keep_one` untouched; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculum.llm import shingles as S
from vinculum.llm.common import fresh, kept_by, over_batches, slices, stage, worker
from vinculum.llm.components import components

kept_by("near_dedup", S.forget)


@dataclass(frozen=True)
class Params:
    """`words` per shingle; link at intersection * 100 >= `percent` * union."""

    words: int = 5
    percent: int = 80
    rows: int = 6
    #: Chance that a pair at the threshold shares no band.
    band_miss: float = 1e-7
    #: A pair is dropped when its posterior chance to reach the threshold is below this.
    miss: float = 1e-6
    #: Signature values compared at a time.
    batch: int = 36
    #: A block holds about so many texts, or so many shingles.
    block_texts: int = 1024
    block_shingles: int = 1_000_000

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.band_miss) / math.log1p(-((self.percent / 100) ** self.rows)))

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def posterior(matches: int, compared: int, threshold: float) -> float:
    """P(similarity >= threshold | matches of compared), uniform prior: a Beta tail as a binomial sum."""
    n = compared + 1
    return math.fsum(math.comb(n, j) * threshold**j * (1 - threshold) ** (n - j) for j in range(matches + 1))


def least_matches(p: Params) -> list[tuple[int, int]]:
    """(values compared, fewest matches that keep a pair) after each batch."""
    ends = [*range(p.batch, p.hashes, p.batch), p.hashes]
    return [(n, next(m for m in range(n + 1) if posterior(m, n, p.percent / 100) >= p.miss)) for n in ends]


def band_keys(signature: np.ndarray, p: Params) -> np.ndarray:
    """One 64-bit key per band (columns) and text (rows)."""
    parts = signature.reshape(len(signature), p.bands, p.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, p.bands + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(p.rows):
        key = S.mix(key * np.uint64(0x9FB21C651E98DF25) + parts[:, :, i])
    return key


@worker("near_dedup")
def _signed(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo, hi in slices(texts, S.CHUNK):
            values, offsets = S.shingle_sets(texts.slice(lo, hi - lo), p.words)
            n = np.diff(offsets)
            full = n > 0
            k = np.zeros((2, hi - lo), np.uint64)
            for i, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
                if full.any():
                    k[i, full] = np.add.reduceat(S.mix(values ^ np.uint64(salt)), offsets[:-1][full])
            keys = band_keys(S.signatures(values, offsets, p.hashes)[full], p)
            ends = np.concatenate([[0], np.cumsum(full * p.bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(lo, hi - lo),
                    pa.array(n.astype(np.int64)),
                    pa.array(k[0].view(np.int64)),
                    pa.array(k[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(keys).view(np.int64).ravel())),
                ],
                names=["doc_id", "n_shingles", "k1", "k2", "bands"],
            )


class _Block:
    """Texts of one block with their sets and signatures, and a union-find over their ids."""

    def __init__(self, hashes: int) -> None:
        self.hashes = hashes
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.signs: list[np.ndarray] = []
        self.matrix: np.ndarray | None = None

    def add(self, doc_id: int, shingles: np.ndarray, signature: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sets.append(shingles)
        self.signs.append(signature)
        self.matrix = None

    def stacked(self) -> np.ndarray:
        if self.matrix is None or len(self.matrix) != len(self.signs):
            self.matrix = np.vstack(self.signs) if self.signs else np.empty((0, self.hashes), np.uint32)
        return self.matrix


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def candidates(matrix: np.ndarray, signature: np.ndarray, p: Params, least: list[tuple[int, int]]) -> np.ndarray:
    """Rows of `matrix` that share a band with `signature` and survive every batch."""
    alive = np.arange(len(matrix))
    matches = np.zeros(len(matrix), np.int64)
    done = 0
    for n, need in least:
        matches = matches + (matrix[alive, done:n] == signature[done:n]).sum(axis=1)
        keep = matches >= need
        alive, matches, done = alive[keep], matches[keep], n
        if not len(alive):
            return alive
    shared = (matrix[alive] == signature).reshape(len(alive), p.bands, p.rows).all(axis=2).any(axis=1)
    return alive[shared]


@worker("near_dedup")
def _verified(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (cluster, i, j, side): block i first, then block j against it."""
    least = least_matches(p)
    group, block, parent = None, _Block(p.hashes), {}
    links: list[tuple[int, int]] = []

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    def against(doc_id: int, shingles: np.ndarray, signature: np.ndarray, upto: int) -> None:
        for c in candidates(block.stacked()[:upto], signature, p, least):
            other = block.ids[c]
            a, b = find(doc_id), find(other)
            if a != b and _similar(block.sets[c], shingles, p.percent):
                parent[max(a, b)] = min(a, b)
                links.append((other, doc_id))

    for batch in batches:
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        keys = list(zip(column["cluster"].to_pylist(), column["i"].to_pylist(), column["j"].to_pylist()))
        sides, ids, texts = column["side"].to_pylist(), column["doc_id"].to_pylist(), column["text"]
        for lo, hi in slices(texts, S.CHUNK):
            values, offsets = S.shingle_sets(texts.slice(lo, hi - lo), p.words)
            signs = S.signatures(values, offsets, p.hashes)
            for r in range(lo, hi):
                if keys[r] != group:
                    group, block, parent = keys[r], _Block(p.hashes), {}
                row = values[offsets[r - lo] : offsets[r - lo + 1]]
                if not len(row):
                    continue
                if sides[r] == 0:
                    block.add(ids[r], row.copy(), signs[r - lo])
                else:
                    against(ids[r], row, signs[r - lo], len(block.ids))
                if keys[r][1] == keys[r][2]:
                    against(ids[r], row, signs[r - lo], len(block.ids) - 1)
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])
            links.clear()


def components_of(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of `docs` (doc_id long, text string)."""
    p = params
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stage(over_batches(docs, partial(_signed, p=p), "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"), "near-signed")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)

    # Classes of equal sets; partial aggregation combines copies before the shuffle.
    classes = stage(signed.filter(linked).groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "near-classes")
    reps = stage(
        signed.filter(linked).join(classes.withColumnRenamed("rep", "doc_id"), ["k1", "k2", "doc_id"], "left_semi").select(F.col("doc_id").alias("rep"), "k1", "n_shingles", "bands"),
        "near-reps",
    )
    banded = reps.select("rep", "k1", F.explode("bands").alias("band"))
    hubs = stage(
        banded.groupBy("band").agg(F.min("rep").alias("hub"), F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo <> hi").select("band", "hub"),
        "near-hubs",
    )
    # A class has at most one hub per band.  It is tied to the smallest and so are its other
    # hubs, which many classes share: the same components from far fewer different ties.
    tied = banded.join(hubs, "band").groupBy("rep").agg(F.collect_set("hub").alias("hubs")).withColumn("a", F.array_min("hubs"))
    ties = tied.select("a", F.explode(F.array_union("hubs", F.array("rep"))).alias("b")).distinct()
    clusters = components(ties, "near-clusters").withColumnRenamed("component", "cluster").withColumnRenamed("node", "rep")

    # Blocks: every text of a cluster of m blocks goes to the m block pairs that hold its block.
    sized = stage(
        clusters.join(reps.groupBy("rep").agg(F.max("n_shingles").alias("n")), "rep")
        .groupBy("cluster")
        .agg(F.greatest(F.ceil(F.count("*") / p.block_texts), F.ceil(F.sum("n") / p.block_shingles)).cast("int").alias("m")),
        "near-sizes",
    )
    placed = clusters.join(sized, "cluster").select(F.col("rep").alias("doc_id"), "cluster", "m", F.pmod(F.xxhash64("rep"), "m").cast("int").alias("at"))
    dealt = (
        docs.join(placed, "doc_id")
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .select("cluster", F.least("at", "with").alias("i"), F.greatest("at", "with").alias("j"), F.when(F.col("at") <= F.col("with"), 0).otherwise(1).alias("side"), "doc_id", "text")
        .repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j", "side")
    )
    links = over_batches(dealt, partial(_verified, p=p), "a long, b long")
    member = signed.select("doc_id", "n_shingles", "k1", "k2")

    # A doc_id with rows of several classes is one node: its classes are tied to their smallest.
    sides = [f(k).alias(f"{k}_{name}") for k in ("k1", "k2") for f, name in ((F.min, "lo"), (F.max, "hi"))]
    twice = stage(member.filter("doc_id is not null").groupBy("doc_id").agg(*sides).filter("k1_lo <> k1_hi or k2_lo <> k2_hi").select("doc_id"), "near-twice")
    held = stage(member.filter(linked).join(twice, "doc_id").join(classes, ["k1", "k2"]).select("doc_id", "rep").distinct(), "near-held")
    nodes = held.groupBy("doc_id").agg(F.min("rep").alias("a"))
    links = links.unionByName(held.join(nodes, "doc_id").select("a", F.col("rep").alias("b")))
    found = components(links, "near-links").select(F.col("node").alias("rep"), "component")

    shared = stage(nodes.join(found.withColumnRenamed("rep", "a"), "a", "left").select("doc_id", F.coalesce("component", "a").alias("component")), "near-shared")
    whole = member.filter(linked).join(classes, ["k1", "k2"]).join(found, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = member.filter(~linked).join(shared, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return whole.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The rows of `docs` but those whose component has a smaller doc_id, with their columns."""
    key = fresh(docs, "_near_id")
    gone = stage(components_of(docs.select("doc_id", "text"), params).filter(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct(), "near-gone")
    return docs.withColumn(key, F.col("doc_id").cast("long")).join(gone, key, "left_anti").drop(key)
