"""Reports: status counts (A1, O2), pipeline report (R1), invalid list (F3), duplicate pairs (F4),
queues (S9-S11), result records (S13), inspection projection (F8, F9) and drift (L9).

Every report is a Spark aggregate or projection; nothing is collected to the driver except
the final, small result the caller asks for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinculum import schemas as S
from vinculum.operators.ingest import Imported


def status_rank(c: Column) -> Column:
    """O2: position of a status in the enum's declaration order."""
    return F.array_position(F.array(*[F.lit(s) for s in S.STATUSES]), c)


def status_counts(state: DataFrame, import_id: str | None = None) -> DataFrame:
    """A1: rows per status, in enum order."""
    df = state if import_id is None else state.filter(F.col("import_id") == import_id)
    return (
        df.groupBy("status")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("status_order", status_rank(F.col("status")))
        .orderBy("status_order")
    )


def invalid_with_reasons(state: DataFrame) -> DataFrame:
    """invalid rows and their reasons, ordered by id."""
    return (
        state.filter(F.col("status") == "invalid")
        .select("import_id", "submission_id", "validation_error")
        .orderBy("submission_id")
    )


def exact_duplicate_pairs(state: DataFrame) -> DataFrame:
    """id -> survivor for exact duplicates, ordered by id."""
    return (
        state.filter(F.col("status") == "exact_duplicate")
        .select("import_id", "submission_id", "duplicate_of")
        .orderBy("submission_id")
    )


def near_duplicate_pairs(state: DataFrame) -> DataFrame:
    return (
        state.filter(F.col("status") == "near_duplicate")
        .select("import_id", "submission_id", "duplicate_of", "matched_product_id")
        .orderBy("submission_id")
    )


def queue(state: DataFrame, status: str) -> DataFrame:
    """The rows of one status (pending, unmatched, review), ordered by id."""
    return state.filter(F.col("status") == status).orderBy("submission_id")


def match_results(state: DataFrame) -> DataFrame:
    """submission_id, decision, confidence, candidate_product_ids, explanation."""
    ids = F.when(F.col("matched_product_id").isNotNull(), F.array(F.col("matched_product_id"))).otherwise(
        F.array().cast("array<string>")
    )
    return state.select(
        "submission_id",
        "status",
        "decision",
        F.col("llm_confidence").alias("confidence"),
        ids.alias("candidate_product_ids"),
        F.coalesce("explanation", "validation_error").alias("explanation"),
    )


def inspect_submissions(state: DataFrame, import_id: str | None = None) -> DataFrame:
    """Short inspection view; the import filter applies only when given."""
    df = state if import_id is None else state.filter(F.col("import_id") == import_id)
    return df.select(
        F.col("submission_id").alias("id"),
        F.left(F.coalesce(F.col("producer"), F.lit("")), F.lit(20)).alias("producer"),
        F.left(F.coalesce(F.col("name"), F.lit("")), F.lit(35)).alias("name"),
        "category",
        F.col("vintage").alias("vint"),
        F.col("size_ml").alias("ml"),
        "status",
        "decision",
        F.col("matched_product_id").alias("matched"),
        F.round(F.col("llm_confidence").cast("decimal(10,4)"), 2).cast("double").alias("conf"),
        F.left(F.coalesce("explanation", "llm_reason", "validation_error", F.lit("")), F.lit(40)).alias("why"),
        status_rank(F.col("status")).alias("status_order"),
    ).orderBy("status_order", "id")


def pipeline_report(imported: Imported, state: DataFrame) -> DataFrame:
    """R1 in long form ``(section, metric, value)``.

    The counts of the input are those of ``imported`` (observed where it was written), one row;
    ``state``, the final rows of the import, is reduced in one pass.
    """
    t1 = F.col("tier1_status")
    src = F.col("llm_source")
    e = F.col("explanation")
    st = F.col("status")
    both = state.agg(
        F.count_if(st == "invalid").alias("invalid"),
        F.count_if(st == "exact_duplicate").alias("exact_demoted"),
        F.count_distinct(F.when(st == "exact_duplicate", F.col("duplicate_of"))).alias("exact_clusters"),
        F.count_if(t1 == "matched").alias("t1_exact_match"),
        F.count_if(t1 == "review").alias("t1_human_review"),
        F.count_if(t1 == "no_match").alias("t1_no_match"),
        F.count_if(t1 == "unmatched").alias("t1_unmatched"),
        F.count_if(src.isNotNull()).alias("t2_processed"),
        F.count_if(src == "cache").alias("t2_cache_hits"),
        F.count_if(src == "error").alias("t2_api_errors"),
        F.count_if(src.isNotNull() & (e == S.LLM_POSSIBLE_MATCH)).alias("t2_auto_applied"),
        F.count_if(src.isNotNull() & e.isin(S.LLM_HUMAN_REVIEW, S.LLM_UNAVAILABLE)).alias("t2_sent_to_review"),
        F.count_if(src.isNotNull() & (e == S.LLM_NO_MATCH)).alias("t2_no_match"),
        F.count_if(st == "near_duplicate").alias("near_demoted"),
        F.count_distinct(F.when(st == "near_duplicate", F.col("duplicate_of"))).alias("near_clusters"),
        *[F.count_if(st == s).alias(f"final_{s}") for s in S.STATUSES],
    )
    missing = reduce(lambda a, b: a + b, [F.col(f"skipped_{r}") for r in S.SKIP_REASONS[:-1]])
    of_input = imported.counts().select("total", missing.alias("skipped_no_id"), "with_id", "inserted")
    rows = both.unionByName(of_input, allowMissingColumns=True)  # two rows, each with its own counts
    both = rows.agg(*[F.sum(c).alias(c) for c in rows.columns])
    c = F.col
    valid = c("inserted") - c("invalid")
    into = valid - c("exact_demoted")
    items: list[tuple[str, str, Column]] = [
        ("input", "records read", c("total")),
        ("input", "without a usable id", c("skipped_no_id")),
        ("input", "repeated ids", c("with_id") - c("inserted")),
        ("input", "kept", c("inserted")),
        ("checks", "failed", c("invalid")),
        ("checks", "passed", valid),
        ("copies", "demoted", c("exact_demoted")),
        ("copies", "groups", c("exact_clusters")),
        ("copies", "left to match", into),
        ("rules", "rows", into),
        ("rules", "exact", c("t1_exact_match")),
        ("rules", "for review", c("t1_human_review")),
        ("rules", "rejected", c("t1_no_match")),
        ("rules", "undecided", c("t1_unmatched")),
        ("model", "rows", c("t2_processed")),
        ("model", "from the cache", c("t2_cache_hits")),
        ("model", "failed calls", c("t2_api_errors")),
        ("model", "accepted", c("t2_auto_applied")),
        ("model", "for review", c("t2_sent_to_review")),
        ("model", "rejected", c("t2_no_match")),
        ("products", "demoted", c("near_demoted")),
        ("products", "groups", c("near_clusters")),
        *[("status", s, c(f"final_{s}")) for s in S.STATUSES],
        ("status", "all", c("inserted")),
    ]
    args: list[Column] = [F.lit(len(items))]
    for section, metric, value in items:
        args += [F.lit(section), F.lit(metric), value.cast("long")]
    return both.select(F.stack(*args).alias("section", "metric", "value"))


def drift_by_import(store: DataFrame) -> DataFrame:
    """Decision distribution and tier-2 confidence per import."""
    return store.groupBy("import_id", "decision").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("llm_confidence"), 4).alias("avg_confidence"),
    )


#: Bins of a confidence between 0 and 1.
CONFIDENCE_BINS = 20


def confidence_bins(store: DataFrame) -> DataFrame:
    """(import_id, created_at, bin, n) for every import with confidences and every bin."""
    conf = F.col("llm_confidence")
    at = F.least(F.floor(conf * CONFIDENCE_BINS).cast("int"), F.lit(CONFIDENCE_BINS - 1))
    counts = store.filter(conf.isNotNull()).groupBy("import_id", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("created_at").alias("created_at"))
    imports = counts.groupBy("import_id").agg(F.min("created_at").alias("created_at"))
    grid = imports.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(CONFIDENCE_BINS - 1))))
    return grid.join(counts.drop("created_at"), ["import_id", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def confidence_shift(store: DataFrame) -> DataFrame:
    """How far each import's confidences moved from those of the import before it.

    ``(import_id, n, psi)``: the population stability index over CONFIDENCE_BINS equal bins,
    half a row added to each; null for the first import.  Everything after the bins is twenty
    rows an import.
    """
    total = F.sum("n").over(Window.partitionBy("import_id"))
    shares = confidence_bins(store).withColumn("p", (F.col("n") + 0.5) / (total + 0.5 * CONFIDENCE_BINS))
    shares = shares.withColumn("q", F.lag("p").over(Window.partitionBy("bin").orderBy("created_at", "import_id")))
    term = (F.col("p") - F.col("q")) * F.ln(F.col("p") / F.col("q"))
    return shares.groupBy("import_id").agg(F.sum("n").alias("n"), F.round(F.sum(term), 6).alias("psi"))


def confidence_sketches(state: DataFrame) -> DataFrame:
    """A mergeable quantile sketch of each import's confidences: (import_id, n, sketch).

    Written per import, sketches answer quantiles over any set of imports
    (:func:`confidence_quantiles`) without reading their rows again.
    """
    rows = state.filter(F.col("llm_confidence").isNotNull())
    return rows.groupBy("import_id").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("llm_confidence").alias("sketch"))


def confidence_quantiles(sketches: DataFrame, ranks: list[float]) -> DataFrame:
    """Approximate quantiles of all the given sketches' rows together: (rank, confidence)."""
    whole = sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    at = F.array(*[F.lit(float(r)) for r in ranks])
    found = F.kll_sketch_get_quantile_double("sketch", at)
    return whole.select(F.explode(F.arrays_zip(at.alias("rank"), found.alias("confidence"))).alias("q")).select("q.*")


def spend_estimate(
    store: DataFrame, tokens_per_call: int = 1500, usd_per_million_tokens: float = 2.50
) -> DataFrame:
    """Model calls per import (cache hits excluded) and the estimated spend."""
    calls = F.count_if(F.col("llm_source").isin("model", "error"))
    price = F.lit(f"{tokens_per_call * usd_per_million_tokens / 1_000_000:.10f}").cast("decimal(20,10)")  # exact, so ties round alike
    return store.groupBy("import_id").agg(
        F.count(F.lit(1)).alias("submissions"),
        F.count_if(F.col("llm_source").isNull()).alias("deterministic"),
        calls.alias("model_calls"),
        F.round(calls.cast("decimal(18,0)") * price, 4).cast("double").alias("est_usd"),
    )
