"""Incremental import of a folder of NDJSON record files with Structured Streaming.

Each micro-batch is one import through every stage (:func:`vinculum.plans.pipeline.run_import`):
validation, ids of earlier imports skipped by a look-up in the store's id index, exact
duplicates, tier 1, tier 2 with the answer cache, propagation, near-duplicate sweep.  Its rows
go to the store's ``import_id`` partition with dynamic partition overwrite, so replaying an
epoch after a failure rewrites the same partition (idempotent sink).  Dedup is against the full
id index, so no watermark is involved.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum import schemas as S
from vinculum.operators import match, resolve
from vinculum.plans.pipeline import run_import
from vinculum.session import scratch_path
from vinculum.sources import jsonsrc
from vinculum.sources import store as ST


def start_stream_import(
    spark: SparkSession,
    source_dir: str,
    store_path: str,
    checkpoint: str,
    catalog: DataFrame | match.CatalogIndex,
    aliases: DataFrame,
    *,
    files_per_batch: int | None = None,
    resolver: resolve.Resolver | None = None,
    model_id: str = S.DEFAULT_MODEL,
    clock: Callable[[], _dt.datetime] = _dt.datetime.now,
):
    """Start the streaming import (``availableNow``: process what is there, then stop).

    ``clock`` is asked once per micro-batch; its answer is the import's time.  A catalog is
    indexed once, before the stream starts.
    """
    if not isinstance(catalog, match.CatalogIndex):
        catalog = match.build_index(catalog)
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(source_dir).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )

    def process(batch: DataFrame, epoch_id: int) -> None:
        run_import(
            batch.sparkSession, jsonsrc.with_record(batch), catalog, aliases,
            import_id=f"stream-{epoch_id:06d}", run_ts=clock(), resolver=resolver, model_id=model_id,
            store_path=store_path, variant=True,
        )

    return (
        lines.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# Deliveries of the driver records: even (or missing) vintages first, odd vintages second.
def delivery_of(vintage):
    return F.when(F.coalesce(vintage, F.lit(0)) % 2 == 0, F.lit(1)).otherwise(F.lit(2))


def deliver_tables(sc) -> str:
    """The driver records of a scenario delivered as two NDJSON drops into one folder, each
    imported by its own ``availableNow`` run of the same streaming query (same checkpoint):
    delivery = micro-batch = import.  Ids of the second delivery already stored by the first are
    skipped (J8); answers of the first serve the second from the cache.  The status stream runs
    after each.  Returns the store's path."""
    from vinculum.sources import tables as TB
    from vinculum.streaming.status import start_status_counts

    spark = sc.spark
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    source, store = f"{base}/source", f"{base}/store"

    def answer(rows: DataFrame) -> DataFrame:
        return resolve.table_resolver(TB.decisions_for(rows, sc.catalog))(rows)

    for d in (1, 2):
        jsonsrc.append_json_lines(TB.raw_submissions(spark, sc.sf_dir).filter(delivery_of(F.col("vintage")) == d), source)
        start_stream_import(spark, source, store, f"{base}/checkpoint", sc.index, sc.aliases, resolver=answer).awaitTermination()
        start_status_counts(spark, store, f"{base}/status-checkpoint").awaitTermination()
    return store
