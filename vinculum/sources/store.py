"""The submission store and catalog sink.

The store is a parquet dataset partitioned by ``import_id``.  An import's rows are written
with dynamic partition overwrite, so rewriting one import leaves every other import alone;
reverting an import drops its partition.  Stage tables (lineage cuts) go under the session's
shared checkpoint folder.

An import is several writes: rows, ids, stored answers.  Its commit marker, a small table
beside the store, is written last and taken away first, and every reader goes by it, so what a
crash leaves behind, or a revert has not deleted yet, is never seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum import schemas as S
from vinculum.functions.text import producer_key
from vinculum.functions.validate import with_fingerprint
from vinculum.operators import audit, resolve
from vinculum.operators.joins import never_broadcast
from vinculum.session import delete_path, full_path, make_folder, names_in, path_exists, scratch_path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    This is the lineage cut between pipeline stages: the new plan starts at a file scan
    (with column pruning and filter pushdown), and a lost executor re-reads files instead of
    recomputing the upstream stages.  Written with zstd: about half the bytes of Spark's default.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def stage_state(state: DataFrame, name: str) -> DataFrame:
    """Rows of an import as a stage table without their fingerprints, which hardly compress and
    follow from the fields: they are neither shuffled nor written where no step needs them."""
    return with_fingerprint(stage_table(state.drop("fingerprint"), name), state.columns)


def stage_changed(
    state: DataFrame,
    changes: Column,
    step: Callable[[DataFrame], DataFrame],
    name: str,
    write: Callable[[DataFrame, str], DataFrame] = stage_table,
) -> DataFrame:
    """``step(state)`` for a step that changes only rows for which ``changes`` holds: these become
    a stage table, the others are read where they are and not written again."""
    return state.filter(~changes | changes.isNull()).unionByName(write(step(state.filter(changes)), name))


#: Order of the stored catalog: a look-up by these columns reads few row groups.
CATALOG_ORDER = ["producer_key", "category", "size_ml"]
#: Keys of a catalog batch that are broadcast to be looked up among the stored ones (about 100
#: bytes each); a larger batch is joined by a shuffle.
BROADCAST_KEYS = 200_000


def write_catalog(catalog: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Products as stored: with their lookup key ``producer_key``, in ranges of CATALOG_ORDER, so
    that the files' and row groups' least and greatest values tell most of them apart."""
    keyed = catalog.withColumn("producer_key", producer_key(F.col("producer")))
    keyed.repartitionByRange(*CATALOG_ORDER).sortWithinPartitions(*CATALOG_ORDER).write.mode(mode).parquet(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def already_stored(stored: DataFrame, batch: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The stored rows whose ``keys`` are among those of a batch of ``n`` rows."""
    wanted = batch.select(keys).distinct()
    return stored.select(keys).join(F.broadcast(wanted) if n <= BROADCAST_KEYS else wanted, keys, "left_semi")


class CatalogRejected(ValueError):
    """A catalog batch that would break a rule; `violations` counts the broken rules."""

    def __init__(self, violations: dict[str, int]) -> None:
        self.violations = violations
        super().__init__("catalog not loaded: " + ", ".join(f"{n} x {k}" for k, n in violations.items()))


def load_catalog(catalog: DataFrame, path: str, mode: str = "append") -> None:
    """Append products, or reload the catalog with ``mode="overwrite"``.

    Domains, the product id and (canonical_name, producer, size_ml) are audited before anything
    is written; a batch that breaks a rule is rejected whole.  So loading a file twice is an
    error, not a second copy.  The stored products have passed this audit, so only the batch is
    grouped; when appending, its keys are looked up among the stored ones, which stay where
    they are.
    """
    spark = catalog.sparkSession
    batch = stage_table(catalog, "catalog-batch")
    counts = {
        "rows outside the domains": audit.catalog_domain_violations(batch).count(),
        "repeated product_id": audit.catalog_key_violations(batch).count(),
        "repeated (canonical_name, producer, size_ml)": audit.catalog_uniqueness(batch).count(),
    }
    if mode == "append" and path_exists(spark, path):
        stored, n = read_catalog(spark, path), batch.count()
        counts["repeated product_id"] += already_stored(stored, batch, ["product_id"], n).count()
        counts["repeated (canonical_name, producer, size_ml)"] += already_stored(stored, batch, ["canonical_name", "producer", "size_ml"], n).count()
    broken = {k: n for k, n in counts.items() if n}
    if broken:
        raise CatalogRejected(broken)
    write_catalog(batch, path, mode)


def write_import(state: DataFrame, path: str, import_id: str | None = None) -> None:
    """Write the rows of one or more imports, replacing only those imports' partitions.

    With ``import_id`` all rows are that import's, whatever their column says, and go to its
    partition's folder as they come.  Without it Spark sorts them by import_id first.
    """
    if import_id is not None:
        folder = state.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(import_id)
        state.drop("import_id").write.mode("overwrite").parquet(f"{path.rstrip('/')}/import_id={folder}")
        return
    (
        state.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("import_id")
        .parquet(path)
    )


# --- commit markers -----------------------------------------------------------------------


def commits_path(store_path: str) -> str:
    """Folder of the commit markers that belong to a store."""
    return f"{store_path.rstrip('/')}-commits"


def answers_path(store_path: str) -> str:
    """Folder of the stored model answers (the tier-2 cache) that belong to a store."""
    return f"{store_path.rstrip('/')}-answers"


def _uncommit(spark: SparkSession, path: str, import_id: str) -> None:
    """Take the marker of an import away: from now on nothing of it is seen."""
    make_folder(spark, commits_path(path))
    delete_path(spark, f"{commits_path(path)}/import_id={import_id}")


def _delete_parts(spark: SparkSession, path: str, import_id: str, cache_path: str | None) -> None:
    for folder in (path.rstrip("/"), ids_path(path), counts_path(path), cache_path or answers_path(path)):
        delete_path(spark, f"{folder}/import_id={import_id}")


def begin_import(spark: SparkSession, path: str, import_id: str, cache_path: str | None = None) -> None:
    """Make way for an import: its marker goes, then what an earlier run of it has written (an
    import that writes no rows would not overwrite them)."""
    _uncommit(spark, path, import_id)
    _delete_parts(spark, path, import_id, cache_path)


def commit_import(spark: SparkSession, path: str, import_id: str, run_ts) -> None:
    """Everything of an import is written: readers see it from now on."""
    row = spark.range(1).select(F.lit(import_id).alias("import_id"), F.lit(run_ts).cast("timestamp").alias("committed_at"))
    row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("import_id").parquet(commits_path(path))


def committed(rows: DataFrame, store_path: str) -> DataFrame:
    """The ``rows`` (partitioned by import_id) of committed imports.

    The markers are one row per import; up to BROADCAST_KEYS of them are broadcast, so that the
    rows stay where they are and Spark prunes their partitions at run time.  A store without
    markers was written directly (:func:`write_import`) and is read whole.
    """
    spark = rows.sparkSession
    if not path_exists(spark, commits_path(store_path)):
        return rows
    markers = spark.read.schema("committed_at timestamp, import_id string").parquet(commits_path(store_path)).select("import_id")
    few = markers.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(markers) if few else markers.distinct(), "import_id", "left_semi").select(rows.columns)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed imports."""
    return committed(spark.read.parquet(path), path)


def read_import(spark: SparkSession, path: str, import_id: str) -> DataFrame:
    """one import (partition pruning on ``import_id``)."""
    return read_store(spark, path).filter(F.col("import_id") == import_id)


# --- look-up tables: stored ids and stored answers ----------------------------------------

class Lookup:
    """A folder of rows in buckets of ``key``, sorted in each, partitioned by import_id.

    A delivery looked up by ``key`` is dealt to the buckets; the stored rows are read bucket by
    bucket and never shuffled.  There are as many buckets as the session of the first import had
    shuffle partitions; the number is kept in the folder.  Buckets are a property of tables, so
    the folder is made a table of the session's catalog, under a name of its own, for as long as
    a plan on it is resolved; dropping it leaves the files.
    """

    _NUMBER = "_buckets-"  # Spark passes over names with an underscore

    def __init__(self, schema: str, key: str) -> None:
        self.schema, self.key = schema, key
        self.columns = [c.split()[0] for c in schema.split(", ")]

    def buckets(self, spark: SparkSession, path: str) -> int:
        make_folder(spark, path)
        kept = [int(n.removeprefix(self._NUMBER)) for n in names_in(spark, path) if n.startswith(self._NUMBER)]
        if not kept:
            kept = [int(spark.conf.get("spark.sql.shuffle.partitions"))]
            make_folder(spark, f"{path.rstrip('/')}/{self._NUMBER}{kept[0]}")
        return kept[0]

    @contextmanager
    def _table(self, spark: SparkSession, path: str) -> Iterator[str]:
        buckets = self.buckets(spark, path)
        name, at = f"vinculum_{uuid.uuid4().hex}", full_path(spark, path).replace("'", "\\'")
        tracked = "spark.sql.hive.manageFilesourcePartitions"
        before = spark.conf.get(tracked)
        spark.conf.set(tracked, "false")  # the partitions are the folders, whoever wrote or deleted them
        try:
            spark.sql(
                f"CREATE TABLE {name} ({self.schema}) USING parquet PARTITIONED BY (import_id) "
                f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {buckets} BUCKETS LOCATION '{at}'"
            )
        finally:
            spark.conf.set(tracked, before)
        try:
            yield name
        finally:
            spark.sql(f"DROP TABLE {name}")

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        with self._table(spark, path) as name:
            return spark.table(name)

    def append(self, rows: DataFrame, path: str) -> None:
        """Add rows (with import_id); one file per bucket and import."""
        with self._table(rows.sparkSession, path) as name:
            rows.select(self.columns).repartition(self.buckets(rows.sparkSession, path), self.key).write.mode("append").insertInto(name)

    def replace(self, rows: DataFrame, path: str, import_id: str) -> None:
        """Write the rows of an import in place of those it wrote before."""
        delete_path(rows.sparkSession, f"{path.rstrip('/')}/import_id={import_id}")
        self.append(rows.withColumn("import_id", F.lit(import_id)), path)


IDS = Lookup("submission_id string, import_id string", "submission_id")
ANSWERS = Lookup(
    "llm_model string, llm_prompt_version string, fingerprint string, llm_output string, updated_at timestamp, import_id string",
    "fingerprint",
)


def write_answers(entries: DataFrame, path: str, import_id: str) -> None:
    """Write an import's cache entries, replacing what the same import wrote before."""
    ANSWERS.replace(entries, path, import_id)


def read_answers(spark: SparkSession, store_path: str | None, path: str) -> DataFrame | None:
    """The stored answers of committed imports; None before the first import."""
    if not path_exists(spark, path):
        return None
    rows = ANSWERS.read(spark, path)
    return committed(rows, store_path) if store_path else rows


def revert_import(store: DataFrame, import_id: str) -> DataFrame:
    """The store without one import (write it back with :func:`write_import` to drop it)."""
    return store.filter(F.col("import_id") != import_id)


def drop_import(spark: SparkSession, path: str, import_id: str, cache_path: str | None = None) -> None:
    """Revert one import: its rows, its ids and the answers it stored.

    The marker goes first, so readers lose the import at once.  An answer of it that rows of
    other imports have used is theirs as well: the oldest of these rows takes its place in the
    cache (what a look-up over all stored rows would find).  Only then are the folders deleted;
    after a crash the call can be repeated.  Records that other imports skipped because of
    this one's ids stay skipped; their next delivery is imported.
    """
    cache_path = cache_path or answers_path(path)
    _uncommit(spark, path, import_id)
    if path_exists(spark, f"{cache_path}/import_id={import_id}"):
        keys = resolve.CACHE_KEYS
        stored = ANSWERS.read(spark, cache_path)
        lost = stored.filter(F.col("import_id") == import_id).select(keys)
        others = read_store(spark, path).filter(F.col("import_id") != import_id).join(never_broadcast(lost), keys, "left_semi")
        heirs = resolve.cache_entries(others, "import_id")
        here = never_broadcast(committed(stored, path).select(keys))
        ANSWERS.append(stage_table(heirs.join(here, keys, "left_anti"), "heirs"), cache_path)
    _delete_parts(spark, path, import_id, cache_path)


# --- status counts ------------------------------------------------------------------------

COUNTS_SCHEMA = "status string, n long, written_at timestamp, import_id string"


def counts_path(store_path: str) -> str:
    """Folder of the status counts that each import of a store writes with its rows."""
    return f"{store_path.rstrip('/')}-counts"


def status_path(store_path: str) -> str:
    """Folder of the status counts that :mod:`vinculum.streaming.status` keeps."""
    return f"{store_path.rstrip('/')}-status"


def write_status_counts(state: DataFrame, store_path: str, import_id: str) -> None:
    """One row per status of the domain, zeros too: a rerun of an import replaces every count."""
    args = [x for s in S.STATUSES for x in (F.lit(s), F.count_if(F.col("status") == s))]
    rows = state.agg(F.stack(F.lit(len(S.STATUSES)), *args).alias("status", "n")).select(
        "status", "n", F.current_timestamp().alias("written_at"), F.lit(import_id).alias("import_id")
    )
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("import_id").parquet(counts_path(store_path))


def read_status_counts(spark: SparkSession, store_path: str) -> DataFrame:
    """A1 per committed import as the status stream's last run left it: (import_id, status, n)."""
    rows = spark.read.schema("status string, n long, import_id string").parquet(status_path(store_path))
    return committed(rows, store_path).filter("n > 0").select("import_id", "status", "n")


# --- index of stored ids ------------------------------------------------------------------


def ids_path(store_path: str) -> str:
    """Folder of the id index that belongs to a store."""
    return f"{store_path.rstrip('/')}-ids"


def write_ids(state: DataFrame, path: str, import_id: str) -> None:
    """Add an import's ids to the id index, replacing what the same import wrote before."""
    IDS.replace(state.select("submission_id"), path, import_id)


def stored_among(records: DataFrame, path: str, exclude_import: str, store_path: str | None = None) -> DataFrame:
    """The ids of ``records`` that other (with ``store_path``: committed) imports have stored.

    A look-up in the narrow id index, not in the store: the distinct ids asked for are dealt to
    its buckets; the index stays where it is.
    """
    asked = records.filter(F.col("submission_id").isNotNull()).select("submission_id").distinct()
    known = IDS.read(records.sparkSession, path).filter(F.col("import_id") != exclude_import)
    if store_path:
        known = committed(known, store_path)
    return known.join(never_broadcast(asked), "submission_id", "left_semi").select("submission_id")
