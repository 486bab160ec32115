"""Import stage: missing-id filter (F5), validation (V*), first-wins id dedup (J8), import summary.

Set-based form of a per-record insert loop.  First-wins inside an id is a ``min`` aggregate
of records (``min_by`` position where a column has no order) keyed by ``submission_id`` (partial
aggregation, so a hot id costs one small buffer per map task, never a whole group in one task);
ids already stored in earlier imports are removed with a ``left_anti`` join.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinculum import schemas as S
from vinculum.functions import record as R
from vinculum.functions import validate as V
from vinculum.operators.joins import never_broadcast


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType, T.CalendarIntervalType))


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


@dataclass
class Imported:
    """Output of :func:`import_records`."""

    state: DataFrame  # inserted rows, STATE_COLUMNS
    records: DataFrame  # every input record: submission_id, skip (null when it has a usable id), raw_json where skip is set
    stored_ids: DataFrame | None  # ids already stored before this import
    counters: dict[str, int] | None = None  # input counts, known once both tables are written

    def records_written(self, write: Callable[[DataFrame, str], DataFrame], name: str = "import") -> tuple[DataFrame, dict[str, int]]:
        """The table of records written by ``write(table, name)`` and read back, with its counts."""
        rows = Observation()
        records = write(self.records.observe(rows, *self._counted()), f"{name}-records")
        return records, rows.get

    def written(
        self,
        write: Callable[[DataFrame, str], DataFrame],
        name: str = "import",
        records: tuple[DataFrame, dict[str, int]] | None = None,
    ) -> Imported:
        """Both tables written by ``write(table, name)`` and read back, their counts observed in
        the writing pass, so that the summary and the report read neither again.  ``records``: what
        :meth:`records_written` gave, where they have been written already.

        The observation stands on top of the plan, in the stage that writes: Spark takes the
        counts of one successful attempt of each task there.  Fingerprints, most of the state's
        bytes, aren't written: they follow from the fields.
        """
        kept = Observation()
        state = self.state.drop("fingerprint").observe(kept, F.count(F.lit(1)).alias("inserted"))
        state = V.with_fingerprint(write(state, f"{name}-imported"), self.state.columns)
        table, counts = records or self.records_written(write, name)
        return Imported(state, table, self.stored_ids, {**counts, **kept.get})

    @staticmethod
    def _counted() -> list[Column]:
        return [
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(F.col("skip") == r).alias(f"skipped_{r}") for r in S.SKIP_REASONS[:-1]],
            F.count_if(F.col("skip").isNull()).alias("with_id"),
        ]

    def counts(self) -> DataFrame:
        """One row: total, skipped_* per reason, with_id and inserted."""
        spark = self.state.sparkSession
        if self.counters is not None:
            return spark.range(1).select(*[F.lit(n).cast("long").alias(k) for k, n in self.counters.items()])
        both = self.records.agg(*self._counted()).unionByName(self.state.agg(F.count(F.lit(1)).alias("inserted")), allowMissingColumns=True)
        return both.agg(*[F.sum(c).alias(c) for c in both.columns])

    def skipped(self) -> DataFrame:
        """Records that were not inserted: (submission_id, reason, n), n records each.

        Counted per id (records less the one kept), so records that are equal in every column,
        input position included, are counted too.
        """
        rec = self.records.groupBy("submission_id", "skip").agg(F.count(F.lit(1)).alias("n"))
        kept = self.state.select("submission_id", F.lit(1).alias("kept"))
        dup = rec.filter(F.col("skip").isNull()).join(never_broadcast(kept), "submission_id", "left").select(
            "submission_id", F.lit("duplicate_id").alias("reason"), (F.col("n") - F.coalesce("kept", F.lit(0))).alias("n")
        )
        no_id = rec.filter(F.col("skip").isNotNull()).select("submission_id", F.col("skip").alias("reason"), "n")
        return no_id.unionByName(dup.filter("n > 0"))

    def rejected(self) -> DataFrame:
        """Records without a usable id, whole: (reason, raw_json)."""
        return self.records.filter(F.col("skip").isNotNull()).select(F.col("skip").alias("reason"), "raw_json")

    def summary(self) -> DataFrame:
        """A6 in long form: metric, value."""
        counts = self.counts().withColumn("skipped_duplicate_id", F.col("with_id") - F.col("inserted"))
        args = [x for c in counts.columns for x in (F.lit(c), F.col(c))]
        return counts.select(F.stack(F.lit(len(counts.columns)), *args).alias("metric", "value"))


#: Columns of a raw record that are not part of the record itself.
_ABOUT = ("position", "id_invalid", "record_invalid", "raw_json", "skip")


def import_records(
    raw: DataFrame,
    import_id: str,
    run_ts: _dt.datetime,
    *,
    variant: bool = False,
    stored_ids: DataFrame | None = None,
    vintage_max: int = S.VINTAGE_MAX,
) -> Imported:
    """Validate and keep one row per new submission id.

    ``raw`` has ``submission_id`` (string; null or ``""`` means missing), ``position``
    (orderable), and either the five fields typed, any further columns being kept in the raw
    record, or, with ``variant``, the record text ``raw_json`` with the flags of
    :func:`vinculum.functions.record.with_id`.

    First-wins comes before validation: the aggregate carries the record only, and rows that
    lose are never validated.
    """
    sid = F.col("submission_id")

    def flag(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(False)

    skip = (
        F.when(flag("record_invalid"), F.lit("invalid_record"))
        .when(flag("id_invalid"), F.lit("invalid_id"))
        .when(sid.isNull() | (sid == ""), F.lit("missing_id"))
    )
    if "raw_json" not in raw.columns:
        whole = [F.col(f"`{c}`") for c in raw.columns if c not in _ABOUT]
        record = lambda: F.to_json(F.struct(*whole))
    else:
        record = lambda: F.col("raw_json")
    records = raw.withColumn("skip", skip)
    carried = ["raw_json"] if variant else [c for c in raw.columns if c not in ("submission_id", "position", "id_invalid", "record_invalid")]
    whole_record = F.struct("position", *[F.col(f"`{c}`") for c in carried])
    if all(_orderable(raw.schema[c].dataType) for c in carried):
        # the position leads the record, so the least record is the first, and is moved once
        least = F.min(F.when(F.col("position").isNotNull(), whole_record))
    else:
        least = F.min_by(whole_record, F.col("position"))
    # Spark sorts by a key's leading bytes, and ids differ at their ends
    by_id = records.filter(F.col("skip").isNull()).groupBy(F.reverse(sid).alias("di"))
    first = by_id.agg(least.alias("r")).select(F.reverse("di").alias("submission_id"), "r.*")
    if stored_ids is not None:
        first = first.join(never_broadcast(stored_ids.select("submission_id")), "submission_id", "left_anti")
    if variant:
        first = R.with_fields(first)
    checks = V.variant_checks(vintage_max) if variant else V.typed_checks(vintage_max)
    trimmed = first.select("*", *V.trimmed_columns(variant))
    first = V.validated(trimmed.withColumn("raw_json", record()), checks, ["submission_id", "position", "raw_json"], variant)

    ts = F.lit(run_ts).cast("timestamp")
    state = first.select(
        "submission_id",
        F.lit(import_id).alias("import_id"),
        "position",
        "name",
        "producer",
        "category",
        "vintage",
        "size_ml",
        "raw_json",
        "status",
        _null("string").alias("decision"),
        _null("string").alias("matched_product_id"),
        _null("string").alias("explanation"),
        _null("double").alias("llm_confidence"),
        _null("string").alias("llm_reason"),
        _null("string").alias("llm_model"),
        _null("string").alias("llm_prompt_version"),
        _null("string").alias("llm_output"),
        "validation_error",
        _null("string").alias("duplicate_of"),
        "fingerprint",
        _null("string").alias("tier1_status"),
        _null("string").alias("llm_source"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )
    seen = records.select("submission_id", "skip", F.when(F.col("skip").isNotNull(), record()).alias("raw_json"))
    return Imported(state=state, records=seen, stored_ids=stored_ids)
