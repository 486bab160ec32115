"""Constraint audits (A15, J9, V8, CHECK) on inline rows with known violations."""

from __future__ import annotations

from vinculum.operators import audit


def test_audits_find_each_violation(spark):
    cat = spark.createDataFrame(
        [("P1", "A", "Prod", "Rum", 700, False), ("P1", "B", "Prod", "Rum", 700, False),
         ("P2", "A", "Prod", "Rum", 700, True), ("P3", "C", "Prod", "Beer", 800, False)],
        "product_id string, canonical_name string, producer string, category string, size_ml int, "
        "vintage_required boolean",
    )
    state = spark.createDataFrame(
        [("S1", "matched", "exact_match", "P1", None, None), ("S2", "matched", "exact_match", "P9", None, None),
         ("S3", "exact_duplicate", None, None, "S7", None), ("S4", "reverted", None, None, None, 1.5)],
        "submission_id string, status string, decision string, matched_product_id string, duplicate_of string, "
        "llm_confidence double",
    )
    assert [r.product_id for r in audit.catalog_key_violations(cat).collect()] == ["P1"]
    uniq = audit.catalog_uniqueness(cat).collect()
    assert [(r.canonical_name, r.n, r.first_product_id) for r in uniq] == [("A", 2, "P1")]
    assert [r.product_id for r in audit.catalog_domain_violations(cat).collect()] == ["P3"]
    assert [r.submission_id for r in audit.state_domain_violations(state).collect()] == ["S4"]
    refs = sorted((r.kind, r.submission_id, r.ref) for r in audit.referential_audit(state, cat).collect())
    assert refs == [("duplicate_of", "S3", "S7"), ("matched_product_id", "S2", "P9")]
    summary = {r.check: r.n for r in audit.constraint_summary(cat, state).collect()}
    assert summary == {"catalog_primary_key": 1, "catalog_unique_name_producer_size": 1, "catalog_domains": 1,
                       "submission_domains": 1, "references": 2}
