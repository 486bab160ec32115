"""Merkle manifest of a dataset, with persistent versions for tampered rows.

A row's leaf is the SHA-256 of its fields, each `-` if null, else its UTF-8 byte count, `:`
and value (integers decimal).  The leaves of a source ascend by doc_id; every `ARITY`
consecutive nodes (last run: fewer, even one) become the SHA-256 of their digests' hex text,
until one, the subroot, remains.  The subroots, by source, give the root in the same way.

1. *Places.* Leaves are sorted by range over all tasks and counted per task and source, so a
   source of any size has its leaves numbered without being gathered.
2. *Up.* Aligned blocks of `ARITY ** LEVELS` nodes are folded to their top node, a block a
   time in one task; the tops are the nodes of the next round, until every source has one
   node; then the sources' tree likewise.
3. *Down.* From the last round to the first, each block gets the path above its top (own place
   and siblings on each level) and hands it on, longer by its own levels.  So upper nodes are
   stored once and shared by all that lies under them.
4. *Versions.* In its block's task a tampered leaf makes a version of the tree: it copies its
   ancestors in the block and then, along the shared upper path, those above it; every other
   node is the base tree's.  The version's last copy is its root.

No task ever holds more than one block and the path above it.

Defined results: null fields are `-`; a null source is a group of its own, the first; a null
doc_id is the first of its source; rows that repeat a doc_id stand in the order of their
leaves (wholly equal rows are interchangeable); very long texts are hashed whole inside the
JVM; the order of columns and extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vinculum.llm.common import over_batches, stage, worker

ARITY = 3
#: Levels of a block: 729 nodes.
LEVELS = 6
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as it is hashed: `-`, or byte count, colon and text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


# --- one block ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Path:
    """The way from a node to the root: per level its place in its run, and the run's others."""

    places: tuple[int, ...] = ()
    siblings: tuple[tuple[str, ...], ...] = ()

    def __add__(self, above: Path) -> Path:
        return Path(self.places + above.places, self.siblings + above.siblings)

    def copied(self, digest: str) -> list[str]:
        """The ancestors that a version copies when the node becomes `digest`, up to its root."""
        out = []
        for place, others in zip(self.places, self.siblings):
            digest = _hash([*others[:place], digest, *others[place:]])
            out.append(digest)
        return out

    def proof(self) -> str:
        return _hash([s for others in self.siblings for s in others])


class Block:
    """The base tree over at most ARITY ** levels consecutive nodes; `n` nodes are in the round."""

    def __init__(self, nodes: list[str], n: int, arity: int, levels: int) -> None:
        self.arity, self.levels = arity, [nodes]
        while n > 1 and len(self.levels) <= levels:
            last = self.levels[-1]
            self.levels.append([_hash(last[i : i + arity]) for i in range(0, len(last), arity)])
            n = -(-n // arity)

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> Path:
        places, siblings = [], []
        for nodes in self.levels[:-1]:
            first = at - at % self.arity
            run = nodes[first : first + self.arity]
            places.append(at - first)
            siblings.append((*run[: at - first], *run[at - first + 1 :]))
            at //= self.arity
        return Path(tuple(places), tuple(siblings))


# --- Spark jobs --------------------------------------------------------------------------

_ABOVE = "places array<int>, siblings array<array<string>>"
_ABOVE_TYPES = [pa.list_(pa.int32()), pa.list_(pa.list_(pa.string()))]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, list[dict]]]:
    """Rows sorted by (grp, block, side): per block its row of side 0, if any, and the others."""
    key, head, rows = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["grp"], row["block"]) != key:
                if rows:
                    yield head, rows
                key, head, rows = (row["grp"], row["block"]), None, []
            if row["side"]:
                rows.append(row)
            else:
                head = row
    if rows:
        yield head, rows


def _path(row: dict | None) -> Path:
    return Path(tuple(row["places"]), tuple(map(tuple, row["siblings"]))) if row else Path()


@worker("merkle")
def _tops(batches: Iterator[pa.RecordBatch], arity: int, levels: int) -> Iterator[pa.RecordBatch]:
    size = arity**levels
    out = []
    for _, rows in _grouped(batches):
        block = Block([r["digest"] for r in rows], rows[0]["n"], arity, levels)
        out.append((rows[0]["grp"], rows[0]["block"], -(-rows[0]["n"] // size), block.top))
        if len(out) >= 4096:
            yield _record(out)
            out = []
    if out:
        yield _record(out)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["grp", "pos", "n", "digest"])


@worker("merkle")
def _paths(batches: Iterator[pa.RecordBatch], arity: int, levels: int) -> Iterator[pa.RecordBatch]:
    """The path of every node of a round."""
    for head, rows in _grouped(batches):
        block, above = Block([r["digest"] for r in rows], rows[0]["n"], arity, levels), _path(head)
        found = [block.path(i) + above for i in range(len(rows))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r["grp"] for r in rows], pa.string()),
                pa.array([r["pos"] for r in rows], pa.int64()),
                pa.array([list(p.places) for p in found], _ABOVE_TYPES[0]),
                pa.array([[list(s) for s in p.siblings] for p in found], _ABOVE_TYPES[1]),
            ],
            names=["grp", "pos", "places", "siblings"],
        )


_PROVEN = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


@worker("merkle")
def _proven(batches: Iterator[pa.RecordBatch], arity: int, levels: int, copies: bool) -> Iterator[pa.RecordBatch]:
    """Proof and version of every leaf."""
    for head, rows in _grouped(batches):
        block, above = Block([r["digest"] for r in rows], rows[0]["n"], arity, levels), _path(head)
        out = []
        for i, r in enumerate(rows):
            path = block.path(i) + above
            now = r["digest"] if r["edited"] is None else r["edited"]
            version = path.copied(now)
            folded = version[-1] if version else now
            out.append((r["doc_id"], r["digest"], head["subroot"], head["root"], path.proof(), folded, folded == head["root"], version if r["edited"] is not None else []))
        columns = list(zip(*out))
        types = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.list_(pa.string())][: 7 + copies]
        names = [c.split()[0] for c in _PROVEN.split(", ")] + ["copied"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names[: len(types)])


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """`rows` with pos (from 0, within grp, by `order`) and n (rows of grp).

    Rows are sorted by range; equal rows are told apart, so a value that a third of all rows
    share is spread over the tasks as well.
    """
    tie = F.xxhash64(F.monotonically_increasing_id())
    rows = stage(rows, f"{name}-rows").withColumn("_tie", tie)
    ranged = rows.repartitionByRange("grp", *order, "_tie").sortWithinPartitions("grp", *order, "_tie")
    ranged = stage(ranged.withColumn("_part", F.spark_partition_id()), f"{name}-ranged")
    counts = ranged.groupBy("grp", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("grp").orderBy("_part")  # a row per task that has rows of the group
    counts = counts.select(
        "grp",
        "_part",
        F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("grp")).alias("n"),
    )
    inside = Window.partitionBy("grp", "_part").orderBy(*order, "_tie")
    at = F.row_number().over(inside) - 1
    placed = ranged.withColumn("_at", at).join(counts, ["grp", "_part"])
    return stage(placed.withColumn("pos", F.col("_before") + F.col("_at")).drop("_part", "_tie", "_at", "_before"), f"{name}-placed")


def _by_block(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("block", F.call_function("div", F.col("pos"), F.lit(size).cast("long"))).withColumn("side", F.lit(1))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "side", "pos")


def _with_heads(nodes: DataFrame, heads: DataFrame, size: int) -> DataFrame:
    """The nodes of each block behind the row of `heads` (grp, pos = block, ...) that belongs to it."""
    heads = heads.withColumn("side", F.lit(0)).withColumnRenamed("pos", "block")
    return _dealt(_by_block(nodes, size).unionByName(heads, allowMissingColumns=True))


def rounds(nodes: DataFrame, name: str, arity: int = ARITY, levels: int = LEVELS) -> list[DataFrame]:
    """`nodes` (grp, pos, n, digest) and the tops of their blocks, round by round, to one node a group."""
    out = [nodes]
    while (out[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rows = _by_block(out[-1].select("grp", "pos", "n", "digest"), arity**levels)
        tops = over_batches(_dealt(rows), partial(_tops, arity=arity, levels=levels), "grp string, pos long, n long, digest string")
        out.append(stage(tops, f"{name}-tops"))
    return out


def _descend(tables: list[DataFrame], top: DataFrame, name: str, arity: int, levels: int) -> DataFrame:
    """Paths (grp, pos, places, siblings) of the nodes of the first of `tables`, whose last
    one's nodes have the paths `top`."""
    step = partial(_paths, arity=arity, levels=levels)
    return reduce(
        lambda above, nodes: stage(over_batches(_with_heads(nodes.select("grp", "pos", "n", "digest"), above, arity**levels), step, f"grp string, pos long, {_ABOVE}"), f"{name}-paths"),
        reversed(tables[:-1]),
        top,
    )


def manifest(docs: DataFrame, tampered: Column | None = None, copies: bool = False, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """One row per row of `docs`: doc_id, leaf, subroot, root, proof_sha256 (of the siblings from
    the leaf to the root), folded_root (of the version in which the text is `tampered`, a
    column over `docs`) and verified (folded_root equals root).

    With `copies`, also `copied`: the digests of the nodes that the row's version copied, its
    parent's first, its root's last; empty where the leaf is unchanged.
    """
    values = [F.col(name) for name in FIELDS]
    digest = leaf(values)
    edited = leaf([*values[:-1], tampered]) if tampered is not None else digest
    group = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))  # null first
    leaves = docs.select(group.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"), edited.alias("edited"))
    leaves = leaves.withColumn("edited", F.when(F.col("edited") != F.col("digest"), F.col("edited")))
    leaves = numbered(leaves, ["doc_id", "digest", "edited"], "merkle-leaves")
    trees = rounds(leaves, "merkle", arity, levels)

    subroots = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("source_key"), "digest")
    subroots = numbered(subroots, ["source_key"], "merkle-sources")
    roots = rounds(subroots, "merkle-upper", arity, levels)
    start = roots[-1].select("grp", "pos", F.array().cast("array<int>").alias("places"), F.array().cast("array<array<string>>").alias("siblings"))
    upper = _descend(roots, start, "merkle-upper", arity, levels)
    tops = subroots.withColumnRenamed("digest", "subroot").join(upper, ["grp", "pos"])
    # One row: the root, behind every source's subroot.
    tops = tops.join(roots[-1].select("grp", F.col("digest").alias("root")), "grp")
    tops = stage(tops.select(F.col("source_key").alias("grp"), F.lit(0).cast("long").alias("pos"), "subroot", "root", "places", "siblings"), "merkle-subroots")

    # The tops of the leaves' blocks get their paths; where a source is one block, that is its subroot's.
    heads = _descend(trees[1:], tops.select("grp", "pos", "places", "siblings"), "merkle", arity, levels) if len(trees) > 1 else tops.select("grp", "pos", "places", "siblings")
    heads = heads.join(tops.select("grp", "subroot", "root"), "grp")
    rows = _with_heads(leaves, heads, arity**levels)
    schema = _PROVEN + (", copied array<string>" if copies else "")
    return stage(over_batches(rows, partial(_proven, arity=arity, levels=levels, copies=copies), schema), "merkle-proven")
