"""JSON sources: catalog (S1), submissions with VARIANT fields (S2, S7), labels (S3).

A submission record is kept whole, as its text.  Its fields are read as VARIANT, so each value
keeps its JSON type: an absent key is a SQL null, a JSON null is a variant null, and strings,
integers, decimals and booleans can be told apart by validation
(``functions.validate.variant_checks``).  A line that doesn't parse is an outcome of its own
(``invalid_record``) with its text.  Newline-delimited JSON and top-level JSON arrays are both
read in splits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum import schemas as S
from vinculum.functions import record as R
from vinculum.operators import audit, ingest
from vinculum.session import scratch_path, share_package
from vinculum.sources import jsonarray
from vinculum.sources.store import stage_table


def with_record(lines: DataFrame) -> DataFrame:
    """Raw records from lines of text (value, file, block): the whole text, id, flags, position.

    Blank lines are no records.  A line that is no JSON object stays, flagged, with its text.
    """
    position = F.struct(F.col("file"), F.col("block"), F.monotonically_increasing_id().alias("row"))
    rows = lines.filter(F.trim("value") != "").select(F.col("value").alias("raw_json"), position.alias("position"))
    return R.with_id(rows)


def read_submissions(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """Raw submission records as whole texts with a string id and an input position.

    Newline-delimited JSON by default.  With ``multiline`` each file is one JSON array, of any
    size, whose elements are the records; it is read in splits (:mod:`vinculum.sources.jsonarray`).
    A broken element, and a file that isn't an array, is one invalid record.
    """
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    if not multiline:
        return with_record(spark.read.text(path).select("value", *where))
    rows = jsonarray.read_elements(spark, path)
    rows = rows.select(F.col("text").alias("raw_json"), F.struct("file", "block", F.col("row").cast("long").alias("row")).alias("position"))
    return R.with_id(rows)


def read_catalog(spark: SparkSession, path: str, *, multiline: bool = True) -> DataFrame:
    """Catalog records; a malformed record or a domain violation aborts the load (V8).

    With ``multiline`` each file is one JSON array, read in splits, else JSON lines.  The records
    are parsed once, into a stage table.
    """
    if multiline:
        texts = jsonarray.read_elements(spark, path).select("text")
    else:
        texts = spark.read.text(path).filter(F.trim("value") != "").select(F.col("value").alias("text"))
    product = F.from_json("text", S.CATALOG_SCHEMA, {"mode": "FAILFAST"}).alias("p")
    df = texts.select(product).select("p.*").withColumn("vintage_required", F.coalesce(F.col("vintage_required"), F.lit(False)))
    df = stage_table(df, "catalog-file")
    if audit.catalog_domain_violations(df).limit(1).count() > 0:
        raise ValueError(f"catalog {path}: a record violates the catalog domains")
    return df


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """S3: eval labels: ``{"labels": [{submission_id, expected_product_id, acceptable_decisions, notes}]}``."""
    schema = "labels array<struct<submission_id string, expected_product_id string, acceptable_decisions array<string>, notes string>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).selectExpr("inline(labels)")


def records_as_json(raw: DataFrame, *keep: str) -> DataFrame:
    """Typed raw records as JSON lines (``value``, with the columns ``keep``), with some values re-typed the way partner files send them.

    Rows are picked by the last character of the id, so the mix is the same at every scale:
    ids ending in 1 get numeric-string vintages (accepted), 2 fractional vintages (rejected),
    3 sizes with a zero decimal (accepted), 4 a boolean name (rejected), 5 a vintage far beyond the
    range as a number, 6 the same as text, and 7 an extra key and, on the next line, a copy of
    the record cut off in the middle (no JSON).  Fields are VARIANT values, so ``to_json``
    writes each with its JSON type and leaves null (absent) fields out.
    """
    h = F.coalesce(F.substring(F.col("submission_id"), -1, 1).try_cast("int"), F.lit(0))
    v = F.col("vintage")
    vintage = (
        F.when(h == 1, v.cast("string").cast("variant"))
        .when(h == 2, (v.cast("decimal(6,1)") + F.lit(0.5).cast("decimal(2,1)")).cast("variant"))
        .when((h == 5) & v.isNotNull(), F.lit(1e30).cast("variant"))
        .when((h == 6) & v.isNotNull(), F.lit("99999999999999999999").cast("variant"))
        .otherwise(v.cast("variant"))
    )
    size = F.when(h == 3, F.col("size_ml").cast("double").cast("variant")).otherwise(
        F.col("size_ml").cast("variant")
    )
    name = F.when(h == 4, F.lit(True).cast("variant")).otherwise(F.col("name").cast("variant"))
    rec = F.struct(
        F.col("submission_id").cast("variant").alias("submission_id"),
        name.alias("name"),
        F.col("producer").cast("variant").alias("producer"),
        F.col("category").cast("variant").alias("category"),
        vintage.alias("vintage"),
        size.alias("size_ml"),
        F.when(h == 7, F.concat(F.lit("SKU of "), F.col("submission_id"))).cast("variant").alias("partner_sku"),
    )
    text = F.to_json(rec)
    broken = F.concat(F.lit('{"submission_id":"'), F.col("submission_id"), F.lit('","name":'))
    return raw.select(*keep, F.explode(F.when(h == 7, F.array(text, broken)).otherwise(F.array(text))).alias("value"))


def _ordered(raw: DataFrame, files: int | None = None) -> DataFrame:
    """Records dealt out by their id, in ``position`` order in each partition: those of one id are
    in one file, in the source order, which is all that first-wins goes by.  A sort of the whole
    would compute every record twice, the first time for the bounds of its ranges."""
    fields = [F.col(f"position.`{f}`") for f in raw.schema["position"].dataType.names]
    has_id = F.col("submission_id") != ""
    key = F.when(has_id, F.xxhash64("submission_id")).otherwise(F.xxhash64(*fields))
    dealt = raw.repartition(files, key) if files else raw.repartition(key)
    return dealt.sortWithinPartitions(*fields, *[F.col(f"`{c}`") for c in raw.columns if c not in ("submission_id", "position")])


def write_json_lines(raw: DataFrame, spark: SparkSession, name: str, ordered: bool = False) -> str:
    """Write typed records as NDJSON under the shared scratch folder; returns the folder.

    ``ordered`` keeps the source order among the records of an id (:func:`_ordered`), so file name
    and row order inside a file reproduce it for first-wins.
    """
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    records_as_json(_ordered(raw) if ordered else raw).write.text(path)
    return path


#: Records in one array file.
ARRAY_RECORDS = 20_000


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a partition as the lines of one JSON array."""
    opened = False

    def lines(texts: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["value"])

    for batch in batches:
        texts = batch.column(0)
        if not opened and len(texts):
            yield lines(pa.array(["["]))
            yield lines(texts[:1])
            opened, texts = True, texts[1:]
        if len(texts):
            yield lines(pc.binary_join_element_wise("", texts, ","))
    if opened:
        yield lines(pa.array(["]"]))


def write_json_arrays(raw: DataFrame, spark: SparkSession, name: str) -> str:
    """Write typed records as files of one JSON array each, about ARRAY_RECORDS in each, those of one
    id in one file in ``position`` order; a record cut off in the middle gets its brace back, so
    that it is one broken element.  Every task writes the lines of its file as it goes."""
    share_package(spark)
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    # files are read in the order of their names, part-00000 to part-99999
    files = min(99_999, max(1, -(-raw.count() // ARRAY_RECORDS)))
    texts = records_as_json(_ordered(raw, files))
    closed = F.when(F.col("value").endswith("}"), F.col("value")).otherwise(F.concat("value", F.lit("}")))
    texts.select(closed.alias("value")).mapInArrow(_as_array, "value string").write.text(path)
    return path


def _in_files(rows: DataFrame, position: str) -> DataFrame:
    """Rows with the file they go to, about ARRAY_RECORDS in each, in order of ``position``."""
    files = max(1, -(-rows.count() // ARRAY_RECORDS))
    return rows.repartitionByRange(files, position).withColumn("file", F.format_string("%08d", F.spark_partition_id()))


def _write_lists(texts: DataFrame, spark: SparkSession, name: str, begin: str, end: str) -> str:
    """One file per ``file``: its values, by position, with commas between."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    # sort_array compares natively; array_sort would run its comparator as an expression per pair
    lists = texts.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("position", "value"))).alias("rows"))
    whole = F.concat(F.lit(begin), F.array_join(F.col("rows.value"), ",\n  "), F.lit(end))
    lists.select("file", whole.alias("value")).write.partitionBy("file").text(path)
    return path


def write_catalog_arrays(catalog: DataFrame, spark: SparkSession, name: str) -> str:
    """Write a catalog as files of one JSON array each; a false ``vintage_required`` is left out."""
    rows = _in_files(catalog, "product_id").withColumn("vintage_required", F.when(F.col("vintage_required"), F.lit(True)))
    texts = rows.select("file", F.col("product_id").alias("position"), F.to_json(F.struct(*catalog.columns)).alias("value"))
    return _write_lists(texts, spark, name, "[\n  ", "\n]")


def write_label_files(labels: DataFrame, spark: SparkSession, name: str) -> str:
    """Write eval labels as files of the form :func:`read_labels` reads."""
    rows = _in_files(labels, "submission_id")
    texts = rows.select("file", F.col("submission_id").alias("position"), F.to_json(F.struct(*labels.columns)).alias("value"))
    return _write_lists(texts, spark, name, '{"labels": [\n  ', "\n]}")


def append_json_lines(raw: DataFrame, path: str) -> None:
    """Append typed records as NDJSON files to ``path`` (one delivery), the source order kept among
    the records of an id."""
    records_as_json(_ordered(raw)).write.mode("append").text(path)


def json_import_from_tables(spark: SparkSession, sf_dir: str) -> ingest.Imported:
    """S2 end to end: driver records -> NDJSON -> whole records -> validation and id dedup."""
    from vinculum.plans.scenario import IMPORT_ID, RUN_TS
    from vinculum.sources import tables as TB

    path = write_json_lines(TB.raw_submissions(spark, sf_dir), spark, "json-import", ordered=True)
    return ingest.import_records(read_submissions(spark, path), IMPORT_ID, RUN_TS, variant=True)


def array_import_from_tables(spark: SparkSession, sf_dir: str) -> ingest.Imported:
    """The same records from files of one JSON array each."""
    from vinculum.plans.scenario import IMPORT_ID, RUN_TS
    from vinculum.sources import tables as TB

    path = write_json_arrays(TB.raw_submissions(spark, sf_dir), spark, "json-arrays")
    return ingest.import_records(read_submissions(spark, path, multiline=True), IMPORT_ID, RUN_TS, variant=True)
