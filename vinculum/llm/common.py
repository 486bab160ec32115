"""Helpers shared by the operators: table access, stage tables, row keys, Arrow slices."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vinculum.session import scratch_path, share_package

#: Whitespace of the operators' word and equality rules, as a regular-expression class.
SPACE = r"[\x20\x09-\x0D]"

#: Text bytes handled at once inside a Python task; bounds numpy temporaries.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Arrow batches to and from Python while a stage is written: rows, and bytes.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2048", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


@contextlib.contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """The session's batch settings are BATCH inside and as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in BATCH}
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs no more than the tasks of one stage, and later
    reads see one fixed set of rows.  Python tasks get small Arrow batches meanwhile, so a
    batch of long texts doesn't fill a worker.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    with _small_batches(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def over_batches(df: DataFrame, task: Callable, schema: str) -> DataFrame:
    """`df` through a function over Arrow batches."""
    share_package(df.sparkSession)
    return df.mapInArrow(task, schema)


#: What Python workers keep between tasks: how to forget it, by operator.
_KEPT: dict[str, list[Callable[[], None]]] = {}


def kept_by(operator: str, forget: Callable[[], None]) -> None:
    _KEPT.setdefault(operator, []).append(forget)


def worker(operator: str) -> Callable:
    """Marks a function over Arrow batches as a task of `operator`.

    Spark reuses Python workers, so a task first drops what other operators left in its
    worker, and gives freed memory back to the system when it ends.
    """

    def mark(task: Callable) -> Callable:
        @functools.wraps(task)
        def run(batches: Iterator, *args, **kwargs) -> Iterator:
            for owner, forgets in _KEPT.items():
                if owner != operator:
                    for forget in forgets:
                        forget()
            _give_back()
            yield from task(batches, *args, **kwargs)
            _give_back()

        return run

    return mark


def _give_back() -> None:
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column holding at most `limit` text bytes (one row at least)."""
    n = len(column)
    if not n:
        return
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield lo, hi
        lo = hi


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
