"""Status counts of the imports, kept by a stream.

Every import writes its counts per status beside its rows.  This query reads those files as
they come, keeps the latest count per (import, status) as streaming state and puts the imports
that a micro-batch touched into a table, so a reader of A1 opens a few rows per import and no
record.  State and progress lie in the checkpoint: a restarted query goes on from there.

A replayed or repeated import writes its counts anew; the latest replace the earlier ones
instead of adding to them, and the table is overwritten per import, so a replayed micro-batch
of this query changes nothing either.  State is one row per import and status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum.session import make_folder
from vinculum.sources import store as ST


def start_status_counts(spark: SparkSession, store_path: str, checkpoint: str):
    """Start the query (``availableNow``: take what is there, then stop)."""
    make_folder(spark, ST.counts_path(store_path))
    rows = spark.readStream.schema(ST.COUNTS_SCHEMA).option("ignoreMissingFiles", True).parquet(ST.counts_path(store_path))
    latest = rows.groupBy("import_id", "status").agg(F.max_by("n", "written_at").alias("n"))

    def put(batch: DataFrame, epoch_id: int) -> None:
        (
            batch.repartition("import_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("import_id")
            .parquet(ST.status_path(store_path))
        )

    return (
        latest.writeStream.outputMode("update")
        .foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
