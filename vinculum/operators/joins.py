"""Join helpers for keys that may hold a large share of the rows.

No side is broadcast by hint: adaptive execution broadcasts from measured bytes.  Before anything
is measured Spark goes by the bytes of files, which can be a fortieth of their rows in memory (ids in
zstd files beside columns of nulls), so a side that grows with the import or the store is
:func:`never_broadcast`.  It also splits
a hot partition of a shuffle join, but only where *both* sides are shuffled for that join; a
side that an aggregate has just partitioned by the same key is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reshuffled(aggregated: DataFrame, key: str) -> DataFrame:
    """`aggregated` with its string column ``key`` recomputed to the same value.

    The planner no longer recognises the aggregate's partitioning, shuffles this (reduced) side
    for the join, and a hot key of the other side can be split over tasks.
    """
    return aggregated.withColumn(key, F.concat(F.col(key), F.lit("")))


def never_broadcast(side: DataFrame) -> DataFrame:
    """`side` for a merge join: it grows with the input, and a broadcast of it would pass through
    the driver's memory."""
    return side.hint("merge")
