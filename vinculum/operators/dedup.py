"""Exact duplicates (A2, A4, A5, U1), near duplicates (A3, U4) and decision propagation.

Groups are found with a plain aggregate (``min(submission_id)``, ``count``) keyed by
(import_id, fingerprint) or (import_id, matched_product_id): partial aggregation keeps a hot
key cheap, and no group is ever collected into one task.  Only groups of two or more are joined
back, and only to the rows that can change (pending / matched / exact_duplicate); every other
row passes through without a shuffle.  Both sides of these joins are shuffled for the join
(:func:`vinculum.operators.joins.reshuffled`), so adaptive execution splits a key that holds a
third of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculum.functions.text import packed_hex, unpacked_hex
from vinculum.operators.joins import never_broadcast, reshuffled


def _groups(rows: DataFrame, key: str) -> DataFrame:
    # the key leads: Spark sorts by the first column's leading bytes, and import_id is one value
    return (
        rows.groupBy(key, "import_id")
        .agg(F.min("submission_id").alias("survivor"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def exact_duplicate_groups(state: DataFrame) -> DataFrame:
    """Fingerprint groups of at least two pending rows, with size and survivor (A4).

    The members of a group are its rows (see :func:`mark_exact_duplicates`); they are never
    gathered into one array, so a hot fingerprint cannot overflow a row or a task.
    """
    pend = state.filter((F.col("status") == "pending") & F.col("fingerprint").isNotNull())
    return _groups(pend, "fingerprint")


def mark_exact_duplicates(state: DataFrame) -> DataFrame:
    """Pending rows sharing a fingerprint become exact_duplicate of the smallest id.

    Idempotent: only pending rows take part, so a second run demotes nothing more (U6).
    ``updated_at`` is not touched (X13).  Fingerprints are most of the bytes that are moved here;
    they go through the shuffles packed (:func:`vinculum.functions.text.packed_hex`).
    """
    cand = (F.col("status") == "pending") & F.col("fingerprint").isNotNull()
    pend = state.filter(cand).withColumn("fingerprint", packed_hex(F.col("fingerprint")))
    rest = state.filter(~cand | cand.isNull())
    groups = reshuffled(_groups(pend, "fingerprint").select("import_id", "fingerprint", "survivor"), "import_id")
    j = pend.join(never_broadcast(groups), ["fingerprint", "import_id"], "left").withColumn("fingerprint", unpacked_hex(F.col("fingerprint")))
    demote = F.col("survivor").isNotNull() & (F.col("submission_id") != F.col("survivor"))
    out = j.withColumn("status", F.when(demote, F.lit("exact_duplicate")).otherwise(F.col("status"))).withColumn(
        "duplicate_of", F.when(demote, F.col("survivor")).otherwise(F.col("duplicate_of"))
    )
    return rest.unionByName(out.select(*state.columns))


def near_duplicate_groups(state: DataFrame) -> DataFrame:
    """A3: product groups of at least two ``matched`` rows (review rows never cluster)."""
    return _groups(state.filter(F.col("status") == "matched"), "matched_product_id")


def mark_near_duplicates(state: DataFrame) -> DataFrame:
    """U4: matched rows sharing a product become near_duplicate of the smallest id.

    matched_product_id and decision stay as the audit trail.  A null product id forms one
    group, as in SQL, hence the null-safe join.
    """
    cand = F.col("status") == "matched"
    m = state.filter(cand)
    rest = state.filter(~cand | cand.isNull())
    groups = _groups(m, "matched_product_id").select(
        F.col("import_id").alias("g_import_id"), F.col("matched_product_id").alias("g_pid"), "survivor"
    )
    groups = never_broadcast(reshuffled(groups, "g_pid"))
    j = m.join(
        groups,
        m.matched_product_id.eqNullSafe(groups.g_pid) & (m.import_id == groups.g_import_id),
        "left",
    )
    demote = F.col("survivor").isNotNull() & (F.col("submission_id") != F.col("survivor"))
    out = j.withColumn("status", F.when(demote, F.lit("near_duplicate")).otherwise(F.col("status"))).withColumn(
        "duplicate_of", F.when(demote, F.col("survivor")).otherwise(F.col("duplicate_of"))
    )
    return rest.unionByName(out.select(*state.columns))


def propagate_to_duplicates(state: DataFrame) -> DataFrame:
    """Exact duplicates take their survivor's matched_product_id and decision.

    Run once after both tiers (the survivor's last decision is what the copies end up with).
    Status, explanation, audit columns and updated_at of the copies are left alone.
    """
    is_dup = F.col("status") == "exact_duplicate"
    rest = state.filter(~is_dup | is_dup.isNull())
    return rest.unionByName(with_survivors(state.filter(is_dup), rest))


def with_survivors(dups: DataFrame, rest: DataFrame) -> DataFrame:
    """The exact duplicates ``dups`` with product and decision of their survivors among ``rest``."""
    # ids differ at their ends, and Spark sorts by a key's leading bytes
    surv = rest.select(
        F.reverse("submission_id").alias("s_di"),
        F.col("matched_product_id").alias("s_pid"),
        F.col("decision").alias("s_decision"),
    )
    j = dups.join(never_broadcast(surv), F.reverse("duplicate_of") == F.col("s_di"), "left")
    out = j.withColumn("matched_product_id", F.col("s_pid")).withColumn("decision", F.col("s_decision"))
    return out.select(*dups.columns)


def _step_summary(groups: DataFrame) -> DataFrame:
    """What a demotion step does to the rows it is given: groups, and rows demoted in them."""
    return groups.agg(
        F.count(F.lit(1)).alias("clusters"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("demoted"),
    )


def exact_duplicate_summary(before: DataFrame) -> DataFrame:
    """A5: clusters and rows that :func:`mark_exact_duplicates` demotes in the state ``before`` it.

    On a state that has been through the step already, both are 0 (U6).
    """
    return _step_summary(exact_duplicate_groups(before))


def near_duplicate_summary(before: DataFrame) -> DataFrame:
    """A5 for the sweep: clusters and rows that :func:`mark_near_duplicates` demotes."""
    return _step_summary(near_duplicate_groups(before))
