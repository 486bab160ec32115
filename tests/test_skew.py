"""Hot keys: one id, one fingerprint and one product each hold about a third of the rows, and the
final plans split the tasks of such a key."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import RUN_TS
from vinculum.operators import dedup, ingest, match, resolve
from vinculum.sources.store import stage_table

N = 3000
CATALOG = "product_id string, canonical_name string, producer string, category string, size_ml int, vintage_required boolean"


def _records(spark, n, distinct_names=False):
    ids = F.col("id")
    third = n // 3
    name = F.when(ids < 2 * third, F.lit("Alpha Beta")).otherwise(
        F.concat(F.lit("alpha"), F.repeat(F.lit(" "), ((ids - 2 * third) % 900 + 1).cast("int")), F.lit("beta!")))
    return spark.range(n).select(
        # a third of the rows share the id HOT; the rest are unique
        F.when(ids < third, F.lit("HOT")).otherwise(F.concat(F.lit("S"), ids.cast("string"))).alias("submission_id"),
        name.alias("name"), F.lit("Prod").alias("producer"), F.lit("Rum").alias("category"), F.lit(2000).alias("vintage"),
        F.lit(700).alias("size_ml"), ids.alias("position"),
    )


def test_hot_id_fingerprint_and_product(spark):
    third = N // 3
    cat = spark.createDataFrame([("P1", "Alpha Beta", "Prod", "Rum", 700, False)], CATALOG)
    al = spark.createDataFrame([], "alias string, canonical string")
    imp = ingest.import_records(_records(spark, N), "hot", RUN_TS)
    st = stage_table(dedup.mark_exact_duplicates(imp.state), "hot")
    st = stage_table(match.match_tier1(st, cat, al, RUN_TS), "hot")
    st = stage_table(dedup.mark_near_duplicates(dedup.propagate_to_duplicates(st)), "hot")
    counts = {r.status: r.n for r in st.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(counts.values()) == 1 + (N - third)
    assert [(r.submission_id, r.n) for r in imp.skipped().collect()] == [("HOT", third - 1)]
    assert counts["matched"] == 1
    surv = st.filter(F.col("status") == "exact_duplicate").groupBy("duplicate_of").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.duplicate_of: r.n for r in surv}["HOT"] == third
    assert st.filter(F.col("status") == "exact_duplicate").select("matched_product_id").distinct().first()[0] == "P1"


@contextlib.contextmanager
def _settings(spark, **values):
    keys = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def small_thresholds(spark):
    """Thresholds at which the hot third of a small table counts as skewed, and no broadcasts."""
    with _settings(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="6",
                   adaptive__advisoryPartitionSizeInBytes="64k", adaptive__skewJoin__skewedPartitionThresholdInBytes="128k",
                   adaptive__skewJoin__skewedPartitionFactor="1.5"):
        yield


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


ROWS = 60_000


def _state(spark, hot, **columns):
    """A staged state of ROWS rows; a third shares the value `hot` of column `key`."""
    ids = F.col("id")
    key = F.when(ids % 3 == 0, F.lit(hot)).otherwise(F.sha2(ids.cast("string"), 256))
    base = {
        "submission_id": F.concat(F.lit("S"), ids.cast("string")), "import_id": F.lit("i"), "name": F.sha2(ids.cast("string"), 512),
        "producer": F.lit("Prod"), "category": F.lit("Rum"), "vintage": F.lit(2000), "size_ml": F.lit(700), "status": F.lit("pending"),
        "decision": F.lit(None).cast("string"), "matched_product_id": F.lit(None).cast("string"), "explanation": F.lit(None).cast("string"),
        "llm_confidence": F.lit(None).cast("double"), "llm_reason": F.lit(None).cast("string"), "llm_model": F.lit(None).cast("string"),
        "llm_prompt_version": F.lit(None).cast("string"), "llm_output": F.lit(None).cast("string"),
        "duplicate_of": F.lit(None).cast("string"), "fingerprint": F.sha2(ids.cast("string"), 256),
        "tier1_status": F.lit(None).cast("string"), "llm_source": F.lit(None).cast("string"), "updated_at": F.lit(RUN_TS),
    }
    base |= {k: v(key, ids) for k, v in columns.items()}
    return stage_table(spark.range(ROWS).repartition(4).select(*[c.alias(n) for n, c in base.items()]), "skew")


def test_hot_fingerprint_is_split(spark, small_thresholds):
    state = _state(spark, "f" * 64, fingerprint=lambda key, ids: key)
    assert "skew=true" in _final_plan(dedup.mark_exact_duplicates(state))


def test_hot_product_is_split(spark, small_thresholds):
    state = _state(spark, "P-hot", matched_product_id=lambda key, ids: key, status=lambda key, ids: F.lit("matched"))
    assert "skew=true" in _final_plan(dedup.mark_near_duplicates(state))


@pytest.mark.parametrize("tokens", [True, False])
def test_hot_signature_is_split(spark, small_thresholds, tokens):
    """Also where no signature lacks tokens, so that the verdicts come from one aggregate alone."""
    def producer(key, ids):
        return F.when(ids % 3 == 0, F.lit("Prod")).otherwise(F.concat(F.lit("Prod "), (ids % 50).cast("string")))

    state = _state(spark, "alpha beta" if tokens else "!!!", name=lambda key, ids: key, producer=producer)
    cat = spark.createDataFrame([("P1", "Alpha Beta", "Prod", "Rum", 700, False)], CATALOG)
    al = spark.createDataFrame([], "alias string, canonical string")
    assert "skew=true" in _final_plan(match.match_tier1(state, match.build_index(cat), al, RUN_TS))


def test_hot_and_missing_candidates(spark, small_thresholds):
    """A third of the answers name one product, a third none: the one is split, the other not joined."""
    def text(key, ids):
        cand = F.when(ids % 3 == 0, F.lit('"P-hot"')).when(ids % 3 == 1, F.lit("")).otherwise(F.concat(F.lit('"P'), ids.cast("string"), F.lit('"')))
        return F.concat(F.lit('{"decision":"possible_match","confidence":0.9,"reason":"r","candidate_product_ids":['), cand, F.lit("]}"))

    state = _state(spark, "x", status=lambda key, ids: F.lit("unmatched"), explanation=text)
    ids = stage_table(spark.range(40_000).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"))
                      .unionByName(spark.range(1).select(F.lit("P-hot").alias("product_id"))), "ids")

    def resolver(rows):
        return rows.withColumn("llm_output", F.col("explanation")).withColumn("llm_error", F.lit(None).cast("string"))

    out = resolve.resolve_unmatched(state, resolver, history=None, catalog_ids=ids, model_id="m", run_ts=RUN_TS)
    plan = _final_plan(out)
    assert "skew=true" in plan
    assert out.filter("matched_product_id = 'P-hot'").count() == ROWS // 3
    assert out.filter("status = 'review' and matched_product_id is null").count() >= ROWS // 3


def test_stages_write_only_rows_they_can_change(spark):
    """A third of the rows can change; the others, a null status included, are not given to the step."""
    from vinculum.sources.store import stage_changed

    state = _state(spark, "x", status=lambda key, ids: F.when(ids % 3 == 0, F.lit("pending")).when(ids % 3 == 1, F.lit(None).cast("string")).otherwise(F.lit("invalid")))
    seen = []

    def step(rows):
        seen.append(rows.count())
        return rows.withColumn("status", F.lit("matched"))

    out = stage_changed(state, F.col("status") == "pending", step, "part")
    assert seen == [ROWS // 3] and out.columns == state.columns
    assert {r.status: r["count"] for r in out.groupBy("status").count().collect()} == {"matched": ROWS // 3, None: ROWS // 3, "invalid": ROWS // 3}


def test_first_record_by_position_even_where_a_column_has_no_order(spark):
    rows = [("a", 2, "Second"), ("a", 1, "First"), ("a", None, "Nowhere"), ("b", 5, "Only")]
    raw = spark.createDataFrame(rows, "submission_id string, position long, name string").select(
        "*", F.lit("Prod").alias("producer"), F.lit("Rum").alias("category"), F.lit(2000).alias("vintage"), F.lit(700).alias("size_ml"))
    wanted = {("a", 1, "First"), ("b", 5, "Only")}
    for records in (raw, raw.withColumn("extra", F.create_map(F.lit("k"), F.lit(1)))):
        state = ingest.import_records(records, "imp", RUN_TS).state
        assert {(r.submission_id, r.position, r.name) for r in state.collect()} == wanted
