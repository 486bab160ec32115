"""Connected components of an edge table, as Spark joins over staged label tables.

Each round hands every node the smallest label among its neighbours and then follows the
label one step (pointer jumping), so the number of rounds grows with the logarithm of the
longest path.  Before the rounds each task replaces its own edges by star forests of a bounded
number of nodes, which shortens paths and keeps one edge per node and forest.  Nothing is collected but the count of
changed labels.  Labels and edges are staged, so both sides of every join are shuffled and
adaptive execution can split the partition of a hot node.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculum.llm.common import over_batches, stage, worker


#: Nodes a task holds before it hands on their forest and starts another.
FOREST_NODES = 1_000_000


@worker("components")
def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def forest() -> Iterator[pa.RecordBatch]:
        nodes = list(parent)
        for lo in range(0, len(nodes), 1 << 16):
            part = nodes[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], names=["a", "b"])
        parent.clear()

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > FOREST_NODES:
            yield from forest()
    yield from forest()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of `edges` (a long, b long); component is its smallest node.

    Self-loops keep a node without other edges; repeated edges change nothing; an empty
    edge table gives an empty result.
    """
    edges = stage(over_batches(edges.select(F.col("a").cast("long"), F.col("b").cast("long")), _local_forest, "a long, b long").distinct(), f"{name}-forest")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).withColumn("component", F.least("node", "component")), f"{name}-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("seen"))
        moved = stage(
            labels.join(near, "node").select("node", F.col("component").alias("before"), F.least("component", "seen").alias("component")),
            f"{name}-moved",
        )
        if moved.filter("component < before").isEmpty():
            return labels
        parents = moved.select(F.col("node").alias("component"), F.col("component").alias("up"))
        labels = stage(moved.select("node", "component").join(parents, "component").select("node", F.col("up").alias("component")), f"{name}-labels")
