"""Catalog, submission records, aliases and labels derived from the driver's parquet tables.

The recipe (product ids, the k-variants of dirty records, the alias rule) is the one in
FIXTURES.md section B; the DuckDB oracle in ``vinculum.plans.oracle`` spells the same recipe
in SQL.  Everything here is lazy and grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum import schemas as S

# p_type -> catalog category (anything else is Cognac)
TYPE_TO_CATEGORY = [
    ("ECONOMY", "Wine"),
    ("LARGE", "Whisky"),
    ("MEDIUM", "Bourbon"),
    ("PROMO", "Tequila"),
    ("SMALL", "Rum"),
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _size_at(idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in S.SIZES_ML]), idx + 1)


def _category(p_type: Column) -> Column:
    expr = None
    for t, c in TYPE_TO_CATEGORY:
        expr = F.when(p_type == t, F.lit(c)) if expr is None else expr.when(p_type == t, F.lit(c))
    return expr.otherwise(F.lit("Cognac"))


def _canonical_name(p: str = "") -> Column:
    return F.concat(F.col(f"{p}p_name"), F.lit(" series "), (F.col(f"{p}p_partkey") % 40).cast("string"))


def _product_id(key: Column) -> Column:
    return F.concat(F.lit("PROD-"), F.lpad(key.cast("string"), 7, "0"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: the canonical catalog, one product per part."""
    part = read_table(spark, sf_dir, "part")
    return part.select(
        _product_id(F.col("p_partkey")).alias("product_id"),
        _canonical_name().alias("canonical_name"),
        F.col("p_brand").alias("producer"),
        _category(F.col("p_type")).alias("category"),
        _size_at(F.col("p_size") % 11).cast("int").alias("size_ml"),
        (F.col("p_partkey") % 5 == 0).alias("vintage_required"),
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias table: the fixed producer aliases plus ``'brand no N' -> 'Brand#N'`` per brand."""
    fixed = spark.createDataFrame(S.PRODUCER_ALIASES, "alias string, canonical string")
    derived = (
        read_table(spark, sf_dir, "part")
        .select(F.col("p_brand").alias("canonical"))
        .distinct()
        .select(F.lower(F.regexp_replace("canonical", "#", " no ")).alias("alias"), "canonical")
    )
    return fixed.unionByName(derived)


def _variant_k() -> Column:
    return (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 20


def _lineitem_parts(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Line items with their part.  ``partitions`` deals a scan of too few splits (one file with
    one row group) out again; leave it out where the files give enough splits."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    if partitions:
        li = li.repartition(partitions)
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return li.join(part, li.l_partkey == part.p_partkey, "inner").withColumn("k", _variant_k())


def _position() -> Column:
    return F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")


def _submission_id() -> Column:
    k, line = F.col("k"), F.col("l_linenumber")
    given = F.concat(F.lit("SUB-"), F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string"))
    return F.when((k == 3) & (line == 5), F.lit(None).cast("string")).when((k == 3) & (line == 4), F.lit("")).otherwise(given)


#: Blanks other than the space, before and after a name.
UNICODE_BLANKS = ("\u00a0\u3000", "\u2003 ")


def raw_submissions(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """B2: dirty submission records (typed fields, ``position`` orders rows of one id).

    Records with k = 4 and line number 6 come twice, equal in every column.
    """
    d = _lineitem_parts(spark, sf_dir, partitions)
    k = F.col("k")
    d = d.withColumn("copy", F.explode(F.when((k == 4) & (F.col("l_linenumber") == 6), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    nm = _canonical_name()
    name = (
        F.when(k == 6, F.upper(nm))
        .when(k == 7, F.regexp_replace(nm, " ", "-"))
        .when(k == 8, F.col("p_name"))
        .when(k == 13, F.lit(""))
        .when(k == 17, F.concat(F.substring("p_name", 1, 3), F.lit(" srs")))
        .when(k == 18, F.concat(F.lit(UNICODE_BLANKS[0]), nm, F.lit(UNICODE_BLANKS[1])))
        .when(k == 19, F.lit("!!!"))
        .otherwise(nm)
    )
    producer = (
        F.when(k == 12, F.lit(None).cast("string"))
        .when((k == 9) | ((k == 17) & (F.col("l_linenumber") == 3)), F.regexp_replace(F.lower("p_brand"), "#", " no "))
        .when((k == 8) & (F.col("l_linenumber") == 2), F.regexp_replace("p_brand", "Brand#", "Brnd "))
        .otherwise(F.col("p_brand"))
    )
    category = F.when(k == 11, F.lit("Beer")).otherwise(_category(F.col("p_type")))
    absent = (k == 16) | ((k == 17) & (F.col("l_suppkey") % 3 == 0))
    vintage = F.when(k == 15, F.lit(1700)).when(absent, F.lit(None)).otherwise(F.year("l_shipdate"))
    size = (
        F.when(k == 14, F.lit(800))
        .when(k == 10, _size_at((F.col("p_size") + 1) % 11))
        .otherwise(_size_at(F.col("p_size") % 11))
    )
    return d.select(
        _submission_id().alias("submission_id"),
        name.alias("name"),
        producer.alias("producer"),
        category.alias("category"),
        vintage.cast("int").alias("vintage"),
        size.cast("int").alias("size_ml"),
        _position().alias("position"),
    )


def labels(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """One eval label per distinct submission id (the first record of the id)."""
    d = _lineitem_parts(spark, sf_dir, partitions).withColumn("submission_id", _submission_id()).filter("submission_id <> ''")
    first = d.groupBy("submission_id").agg(
        F.min_by(F.struct("k", "p_partkey"), _position()).alias("f")
    )
    k = F.col("f.k")
    expected = F.when(k.isin(10, 11, 12, 13, 14, 15, 19), F.lit(None).cast("string")).otherwise(
        _product_id(F.col("f.p_partkey"))
    )
    acceptable = (
        F.when(k.isin(12, 13, 14, 15), F.array(F.lit("invalid")))
        .when(k.isin(10, 11), F.array(F.lit("no_match")))
        .when(k == 9, F.array(F.lit("exact_match"), F.lit("possible_match")))
        .when(k.isin(8, 17), F.array(F.lit("human_review"), F.lit("possible_match")))
        .when(k == 19, F.array(F.lit("human_review")))
        .otherwise(F.array(F.lit("exact_match")))
    )
    return first.select(
        "submission_id",
        expected.alias("expected_product_id"),
        acceptable.alias("acceptable_decisions"),
        F.concat(F.lit("variant "), k.cast("string")).alias("notes"),
    )


# --- tier-2 inputs derived from the tables (FIXTURES.md B4) ---------------------------------

HEX = "0123456789abcdef"
ERROR_BUCKET = 15
UNKNOWN_PRODUCT = "PROD-NOWHERE"


def hex_bucket(fp: Column, pos: int = 1) -> Column:
    """Value 0..15 of one hex digit of a fingerprint."""
    return F.instr(F.lit(HEX), F.substring(fp, pos, 1)) - 1


def decision_json(bucket: Column, candidate: Column) -> Column:
    """Model answer text for a bucket: decision by ``b % 4``, confidence ``(b + 4) / 20``."""
    dec = F.element_at(F.array(*[F.lit(x) for x in S.MODEL_DECISIONS]), (bucket % 4) + 1)
    conf = ((bucket + 4) / 20.0).cast("decimal(3,2)").cast("string")
    ids = F.when(candidate.isNotNull(), F.concat(F.lit('["'), candidate, F.lit('"]'))).otherwise(F.lit("[]"))
    return F.concat(
        F.lit('{"decision":"'), dec,
        F.lit('","confidence":'), conf,
        F.lit(',"candidate_product_ids":'), ids,
        F.lit(',"reason":"rule bucket '), bucket.cast("string"), F.lit('"}'),
    )


def _block_first(catalog_df: DataFrame) -> DataFrame:
    return catalog_df.groupBy(F.lower("producer").alias("pk"), "category").agg(F.min("product_id").alias("cand"))


def decisions_for(rows: DataFrame, catalog_df: DataFrame, shift: int | Column = 0, keys: tuple[str, ...] = ("fingerprint",)) -> DataFrame:
    """Decisions table ``(fingerprint, llm_output, llm_error)`` for the fingerprints of ``rows``.

    The candidate is the smallest product id of the row's producer/category block (or none); a
    third hex digit 0 or 1 names a product the catalog doesn't have, 2 none;
    bucket ``(b + shift) % 16`` of the fingerprint's first hex digit picks the answer, and the
    last bucket is an error without output.
    """
    extra = [k for k in keys if k != "fingerprint"]
    shift_col = shift if isinstance(shift, Column) else F.lit(shift)
    fps = rows.select(*keys, F.lower("producer").alias("pk"), "category", shift_col.alias("_shift")).dropDuplicates(
        list(keys)
    )
    j = fps.join(_block_first(catalog_df), ["pk", "category"], "left")
    third = F.substring("fingerprint", 3, 1)
    j = j.withColumn("cand", F.when(third.isin("0", "1"), F.lit(UNKNOWN_PRODUCT)).when(third != "2", F.col("cand")))
    b = (hex_bucket(F.col("fingerprint")) + F.col("_shift")) % 16
    err = b == ERROR_BUCKET
    return j.select(
        "fingerprint",
        *extra,
        F.when(~err, decision_json(b, F.col("cand"))).alias("llm_output"),
        F.when(err, F.concat(F.lit("ResolverError: no answer for bucket "), b.cast("string"))).alias("llm_error"),
    )


# Stored answers of an earlier import: (suffix, fingerprint second digits, bucket shift,
# updated_at, prompt version).  The older answer of the current version wins the cache; those of
# the old version are ignored.
HISTORY_SETS = [
    ("a", "02468ace", 1, "2025-01-02 00:00:00", S.PROMPT_VERSION),
    ("b", "02468ace", 2, "2025-01-03 00:00:00", S.PROMPT_VERSION),
    ("c", "0", 3, "2024-12-31 00:00:00", S.OLD_PROMPT_VERSION),
]


def history_rows(unmatched: DataFrame) -> DataFrame:
    """Earlier-import copies of unmatched rows, one per (fingerprint, answer set) of HISTORY_SETS.

    Adds ``h_shift``, ``h_ts`` and ``h_version``; the sets come from one explode, so the
    unmatched rows are read once.
    """
    sets = F.array(*[
        F.struct(F.lit(sfx).alias("sfx"), F.lit(dg).alias("digits"), F.lit(sh).alias("shift"),
                 F.lit(ts).cast("timestamp").alias("ts"), F.lit(v).alias("version"))
        for sfx, dg, sh, ts, v in HISTORY_SETS
    ])
    fps = unmatched.dropDuplicates(["fingerprint"]).withColumn("h", F.explode(sets))
    sel = fps.filter(F.instr(F.col("h.digits"), F.substring("fingerprint", 2, 1)) > 0)
    return sel.select(
        "*",
        F.col("h.shift").alias("h_shift"),
        F.col("h.ts").alias("h_ts"),
        F.col("h.version").alias("h_version"),
    ).withColumn(
        "submission_id", F.concat(F.lit("HIST-"), F.col("fingerprint"), F.lit("-"), F.col("h.sfx"))
    ).drop("h")
