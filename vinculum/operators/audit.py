"""Constraint audits that a relational store would enforce: keys (A15), domains (CHECK),
not-null columns, and references (J9).  Each returns the offending rows or counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculum import schemas as S


def catalog_uniqueness(catalog: DataFrame) -> DataFrame:
    """(canonical_name, producer, size_ml) groups with more than one product."""
    return (
        catalog.groupBy("canonical_name", "producer", "size_ml")
        .agg(F.count(F.lit(1)).alias("n"), F.min("product_id").alias("first_product_id"))
        .filter(F.col("n") > 1)
    )


def catalog_key_violations(catalog: DataFrame) -> DataFrame:
    """Primary key audit: product ids that occur more than once."""
    return catalog.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def catalog_domain_violations(catalog: DataFrame) -> DataFrame:
    """V8 / CHECK: catalog rows with an unknown category, size, or a null required column."""
    bad = (
        ~F.col("category").isin(*S.CATEGORIES)
        | ~F.col("size_ml").isin(*S.SIZES_ML)
        | F.col("product_id").isNull()
        | F.col("canonical_name").isNull()
        | F.col("producer").isNull()
    )
    return catalog.filter(F.coalesce(bad, F.lit(True)))


def state_domain_violations(state: DataFrame) -> DataFrame:
    """CHECK on stored submissions: status/decision domains and confidence in [0, 1]."""
    bad = (
        ~F.col("status").isin(*S.STATUSES)
        | (F.col("decision").isNotNull() & ~F.col("decision").isin(*S.DECISIONS))
        | (F.col("llm_confidence").isNotNull() & ~F.col("llm_confidence").between(0.0, 1.0))
    )
    return state.filter(F.coalesce(bad, F.lit(True)))


def referential_audit(state: DataFrame, catalog: DataFrame) -> DataFrame:
    """matched_product_id not in the catalog, duplicate_of not a stored submission.

    Two left-anti joins; one row per broken reference ``(kind, submission_id, ref)``.
    """
    pid = state.filter(F.col("matched_product_id").isNotNull()).select(
        "submission_id", F.col("matched_product_id").alias("ref")
    )
    bad_pid = pid.join(catalog.select(F.col("product_id").alias("ref")), "ref", "left_anti").select(
        F.lit("matched_product_id").alias("kind"), "submission_id", "ref"
    )
    dup = state.filter(F.col("duplicate_of").isNotNull()).select("submission_id", F.col("duplicate_of").alias("ref"))
    bad_dup = dup.join(state.select(F.col("submission_id").alias("ref")), "ref", "left_anti").select(
        F.lit("duplicate_of").alias("kind"), "submission_id", "ref"
    )
    return bad_pid.unionByName(bad_dup)


def constraint_summary(catalog: DataFrame, state: DataFrame) -> DataFrame:
    """Counts of every audit, one row each (zero when clean): ``(check, n)``."""
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")
    return (
        one(catalog_key_violations(catalog), "catalog_primary_key")
        .unionByName(one(catalog_uniqueness(catalog), "catalog_unique_name_producer_size"))
        .unionByName(one(catalog_domain_violations(catalog), "catalog_domains"))
        .unionByName(one(state_domain_violations(state), "submission_domains"))
        .unionByName(one(referential_audit(state, catalog), "references"))
    )
