"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Column names and sets equal those of the DuckDB oracle in ``vinculum.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum.functions.text import normalize, percent, tokens
from vinculum.operators import audit, dedup, evaluate as E, match, report, resolve
from vinculum.operators.match import catalog_find
from vinculum.plans.scenario import HISTORY_CREATED, HISTORY_IMPORT_ID, IMPORT_ID, RUN_TS, scenario
from vinculum.session import scratch_path
from vinculum.sources import jsonsrc
from vinculum.sources import store as ST
from vinculum.sources import tables as TB

Query = Callable[[SparkSession, str], DataFrame]


def _sc(spark: SparkSession, sf: str):
    return scenario(spark, sf)


def q_catalog_find(spark, sf):
    path = scratch_path(spark, f"catalog-{uuid.uuid4().hex}")
    ST.write_catalog(TB.catalog(spark, sf), path)
    return catalog_find(ST.read_catalog(spark, path), producer="brand#13", category="Rum")


def q_catalog_uniqueness(spark, sf):
    return audit.catalog_uniqueness(_sc(spark, sf).catalog).select("canonical_name", "producer", "size_ml", "n")


def q_missing_id_filter(spark, sf):
    rec = _sc(spark, sf).imported.records
    return rec.groupBy(F.coalesce(F.col("skip"), F.lit("has_id")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def q_duplicate_ids_skipped(spark, sf):
    return _sc(spark, sf).imported.skipped()


def q_import_summary(spark, sf):
    return _sc(spark, sf).imported.summary()


def _imported(spark, sf):
    return _sc(spark, sf).imported.state


def q_validate_fields(spark, sf):
    return _imported(spark, sf).select(
        "submission_id", "status", "validation_error", "name", "producer", "category", "vintage", "size_ml"
    )


def q_invalid_with_reasons(spark, sf):
    return report.invalid_with_reasons(_imported(spark, sf)).select("submission_id", "validation_error")


def q_normalize_names(spark, sf):
    st = _imported(spark, sf).filter(F.col("name").isNotNull())
    return st.select("submission_id", normalize(F.col("name")).alias("norm"))


def q_token_sets(spark, sf):
    st = _imported(spark, sf).filter(F.col("name").isNotNull())
    t = tokens(normalize(F.col("name")))
    return st.select("submission_id", F.array_join(F.array_sort(t), " ").alias("tokens"), F.size(t).alias("n_tokens"))


def q_fingerprints(spark, sf):
    return _imported(spark, sf).filter(F.col("fingerprint").isNotNull()).select("submission_id", "fingerprint")


def q_exact_duplicate_groups(spark, sf):
    return dedup.exact_duplicate_groups(_imported(spark, sf)).select("fingerprint", "n", "survivor")


def q_exact_duplicate_pairs(spark, sf):
    return report.exact_duplicate_pairs(_sc(spark, sf).deduped).select("submission_id", "duplicate_of")


def q_exact_duplicate_summary(spark, sf):
    return dedup.exact_duplicate_summary(_imported(spark, sf))


def q_pending_queue(spark, sf):
    return report.queue(_sc(spark, sf).deduped, "pending").select(
        "submission_id", "name", "producer", "category", "vintage", "size_ml", "fingerprint"
    )


def q_producer_alias(spark, sf):
    sc = _sc(spark, sf)
    pend = sc.deduped.filter(F.col("status") == "pending")
    return match.with_producer_key(pend, sc.aliases).select("submission_id", "producer", "producer_key")


def q_category_reject(spark, sf):
    sc = _sc(spark, sf)
    p = match.pending_signatures(sc.deduped, sc.aliases)
    return p.filter(~F.col("in_scope")).select("submission_id", "category")


def q_candidate_pairs(spark, sf):
    sc = _sc(spark, sf)
    return match.row_candidate_pairs(sc.deduped, sc.index, sc.aliases, pending=sc.pending)


def q_candidate_counts(spark, sf):
    sc = _sc(spark, sf)
    o = match.tier1_outcomes(sc.deduped, sc.index, sc.aliases, pending=sc.pending).filter(F.col("in_scope"))
    return o.select(
        "submission_id",
        F.coalesce(F.col("n_at_size"), F.lit(0)).alias("n_at_size"),
        F.coalesce(F.col("n_any"), F.lit(0)).alias("n_any"),
    )


def q_candidate_counts_dense(spark, sf):
    """J3 with bitmaps for every token of more than four token sets of a block: the same counts."""
    sc = _sc(spark, sf)
    index = replace(match.build_index(sc.catalog, dense=4), few=0)
    o = match.tier1_outcomes(sc.deduped, index, sc.aliases, pending=sc.pending).filter(F.col("in_scope"))
    return o.select(
        "submission_id",
        F.coalesce(F.col("n_at_size"), F.lit(0)).alias("n_at_size"),
        F.coalesce(F.col("n_any"), F.lit(0)).alias("n_any"),
    )


def _tier1_rows(spark, sf):
    return _sc(spark, sf).tier1.filter(F.col("tier1_status").isNotNull())


def q_match_tier1(spark, sf):
    return _tier1_rows(spark, sf).select("submission_id", "status", "decision", "matched_product_id", "explanation")


def q_match_tier1_counts(spark, sf):
    return _tier1_rows(spark, sf).groupBy("status", "decision", "explanation").agg(F.count(F.lit(1)).alias("n"))


def q_match_summary(spark, sf):
    return match.match_summary(_sc(spark, sf).tier1)


def q_unmatched_queue(spark, sf):
    return report.queue(_sc(spark, sf).tier1, "unmatched").select(
        "submission_id", "name", "producer", "category", "vintage", "size_ml", "fingerprint"
    )


def q_request_table(spark, sf):
    sc = _sc(spark, sf)
    return resolve.request_table(sc.tier1, sc.catalog, sc.aliases).select(
        "submission_id", "user_text", "block_products", "found_products", "near_blocks"
    )


def q_request_candidates(spark, sf):
    sc = _sc(spark, sf)
    return resolve.request_candidates(sc.tier1, sc.catalog, sc.aliases)


def q_request_near_blocks(spark, sf):
    sc = _sc(spark, sf)
    return resolve.near_blocks(sc.tier1, sc.catalog, sc.aliases)


def q_decision_cache(spark, sf):
    sc = _sc(spark, sf)
    return resolve.decision_cache(sc.history, sc.model_id).join(
        sc.tier1.filter(F.col("status") == "unmatched").select("fingerprint").distinct(), "fingerprint", "left_semi"
    )


def _tier2_rows(spark, sf):
    return _sc(spark, sf).tier2.filter(F.col("llm_source").isNotNull())


def q_apply_decisions(spark, sf):
    return _tier2_rows(spark, sf).select(
        "submission_id", "status", "decision", "matched_product_id", "explanation", "llm_confidence", "llm_reason",
        "llm_source",
    )


def q_apply_decisions_unchecked(spark, sf):
    """H6 flag off: confident answers apply whatever product they name."""
    return _sc(spark, sf).tier2_unchecked.filter(F.col("llm_source").isNotNull()).select(
        "submission_id", "status", "decision", "matched_product_id", "explanation"
    )


def q_llm_summary(spark, sf):
    return resolve.llm_summary(_sc(spark, sf).tier2)


def q_duplicate_propagation(spark, sf):
    return _sc(spark, sf).tier2.filter(F.col("status") == "exact_duplicate").select(
        "submission_id", "duplicate_of", "matched_product_id", "decision"
    )


def q_near_duplicate_groups(spark, sf):
    return dedup.near_duplicate_groups(_sc(spark, sf).tier2).select("matched_product_id", "n", "survivor")


def q_near_duplicate_pairs(spark, sf):
    return report.near_duplicate_pairs(_sc(spark, sf).final).select("submission_id", "duplicate_of", "matched_product_id")


def q_status_counts(spark, sf):
    return report.status_counts(_sc(spark, sf).final)


def q_review_queue(spark, sf):
    return report.queue(_sc(spark, sf).final, "review").select(
        "submission_id", "decision", "matched_product_id", "explanation"
    )


def q_match_results(spark, sf):
    r = report.match_results(_sc(spark, sf).final)
    return r.withColumn("candidate_product_ids", F.array_join("candidate_product_ids", ","))


def q_inspect_submissions(spark, sf):
    return report.inspect_submissions(_sc(spark, sf).final)


def q_inspect_import(spark, sf):
    """the inspection view of one import of the store."""
    return report.inspect_submissions(_sc(spark, sf).store, IMPORT_ID)


def q_output_datasets(spark, sf):
    """Rows of each output dataset."""
    from vinculum.plans.pipeline import output_counts

    return output_counts(_sc(spark, sf).final)


def q_final_state(spark, sf):
    """Every stored column of the import (the raw record is in json_raw_records)."""
    st = _sc(spark, sf).final
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return st.select(*[stamp(c) if c in ("created_at", "updated_at") else c for c in st.columns])


def q_pipeline_report(spark, sf):
    sc = _sc(spark, sf)
    return report.pipeline_report(sc.imported, sc.final)


def _scored(spark, sf):
    sc = _sc(spark, sf)
    return E.scored(sc.labels, E.outcomes_of_latest(sc.store))


def q_eval_overall(spark, sf):
    return E.overall(_scored(spark, sf))


def q_eval_decisions(spark, sf):
    return E.decisions_histogram(_scored(spark, sf))


def q_eval_tiers(spark, sf):
    return E.tiers(_scored(spark, sf))


def q_eval_by_set(spark, sf):
    return E.by_acceptable_set(_scored(spark, sf))


def q_eval_percentages(spark, sf):
    """Share of right answers per acceptable set as printed in reports."""
    return E.by_acceptable_set(_scored(spark, sf)).select("class_key", percent(F.col("correct"), F.col("n")).alias("share"))


def q_eval_misses(spark, sf):
    return E.misses(_scored(spark, sf))


def q_latest_import(spark, sf):
    return E.latest_import(_sc(spark, sf).store)


def q_referential_audit(spark, sf):
    sc = _sc(spark, sf)
    return audit.referential_audit(sc.tier2_unchecked, sc.catalog)


def q_confidence_shift(spark, sf):
    return report.confidence_shift(_sc(spark, sf).store)


def q_drop_import(spark, sf):
    """Both imports written as a store, then the history import dropped: what is left of each kind."""
    sc = _sc(spark, sf)
    path = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    answers, cache = ST.answers_path(path), None
    for rows, name, ts in ((sc.history, HISTORY_IMPORT_ID, HISTORY_CREATED), (sc.final, IMPORT_ID, RUN_TS)):
        ST.begin_import(spark, path, name)
        ST.write_import(rows, path, name)
        ST.write_ids(rows, ST.ids_path(path), name)
        cache = ST.read_answers(spark, path, answers)
        ST.write_answers(resolve.new_cache_entries(rows, cache), answers, name)
        ST.commit_import(spark, path, name, ts)
    ST.drop_import(spark, path, HISTORY_IMPORT_ID)
    kinds = {"rows": ST.read_store(spark, path), "ids": spark.read.parquet(ST.ids_path(path)), "answers": ST.read_answers(spark, path, answers)}
    parts = [df.groupBy("import_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "import_id", "n") for kind, df in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_json_catalog(spark, sf):
    """The catalog from files of one JSON array each."""
    return jsonsrc.read_catalog(spark, jsonsrc.write_catalog_arrays(_sc(spark, sf).catalog, spark, "json-catalog"))


def q_json_labels(spark, sf):
    """S3: the eval labels from label files."""
    labels = jsonsrc.read_labels(spark, jsonsrc.write_label_files(_sc(spark, sf).labels, spark, "json-labels"))
    return labels.select("submission_id", "expected_product_id", F.array_join("acceptable_decisions", ", ").alias("acceptable"), "notes")


def q_catalog_append(spark, sf):
    """Half of the products loaded, the others appended, these rejected when appended again, the
    first half reloaded, and the whole catalog with its repeated keys: (step, what, n)."""
    cat, path = _sc(spark, sf).catalog, scratch_path(spark, f"catalog-{uuid.uuid4().hex}")
    key = ["canonical_name", "producer", "size_ml"]
    first = cat.groupBy(*key).agg(F.min("product_id").alias("product_id")).select("product_id")
    single = cat.join(first, "product_id", "left_semi")
    odd = F.substring("product_id", -1, 1).cast("int") % 2 == 1
    steps = [
        ("load", single.filter(odd), path, "append"),
        ("append", single.filter(~odd), path, "append"),
        ("append again", single.filter(~odd), path, "append"),
        ("reload", single.filter(odd), path, "overwrite"),
        ("with repeats", cat, f"{path}-whole", "append"),
    ]
    found = []
    for step, batch, to, mode in steps:
        try:
            ST.load_catalog(batch, to, mode)
            found.append((step, "stored", ST.read_catalog(spark, to).count()))
        except ST.CatalogRejected as e:
            found += [(step, rule, n) for rule, n in e.violations.items()]
    return spark.createDataFrame(found, "step string, what string, n long")


def q_stored_import(spark, sf):
    """one import of a store that holds two committed ones and one that is not."""
    sc = _sc(spark, sf)
    path = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    for rows, name in ((sc.history, HISTORY_IMPORT_ID), (sc.final, IMPORT_ID), (sc.history, "import-0002")):
        ST.write_import(rows, path, name)
    for name, ts in ((HISTORY_IMPORT_ID, HISTORY_CREATED), (IMPORT_ID, RUN_TS)):
        ST.commit_import(spark, path, name, ts)
    mine = ST.read_import(spark, path, IMPORT_ID)
    return mine.unionByName(ST.read_import(spark, path, "import-0002")).select("import_id", "submission_id", "status", "matched_product_id", "duplicate_of")


def q_stored_ids(spark, sf):
    """The ids of a repeated delivery that committed imports have stored.  Ids of invalid rows
    were written by an import that wasn't committed."""
    sc = _sc(spark, sf)
    path = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    bad = F.col("status") == "invalid"
    ST.write_ids(sc.final.filter(~bad), ST.ids_path(path), IMPORT_ID)
    ST.write_ids(sc.final.filter(bad), ST.ids_path(path), "import-0002")
    ST.commit_import(spark, path, IMPORT_ID, RUN_TS)
    return ST.stored_among(sc.raw, ST.ids_path(path), "import-0003", path)


def q_stored_answers(spark, sf):
    """The stored answers that the unmatched rows find."""
    sc = _sc(spark, sf)
    path = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    ST.write_answers(resolve.new_cache_entries(sc.history, None), ST.answers_path(path), HISTORY_IMPORT_ID)
    ST.commit_import(spark, path, HISTORY_IMPORT_ID, HISTORY_CREATED)
    hits = resolve.cache_lookup(ST.read_answers(spark, path, ST.answers_path(path)), sc.model_id)
    return hits.join(sc.tier1.filter(F.col("status") == "unmatched").select("fingerprint").distinct(), "fingerprint", "left_semi")


def q_revert_import(spark, sf):
    st = ST.revert_import(_sc(spark, sf).store, HISTORY_IMPORT_ID)
    return st.groupBy("import_id", "status").agg(F.count(F.lit(1)).alias("n"))


def q_drift_by_import(spark, sf):
    return report.drift_by_import(_sc(spark, sf).store)


def q_cache_table(spark, sf):
    """J5 as a maintained table: one row per (model, prompt version, fingerprint), oldest answer."""
    return resolve.cache_entries(_sc(spark, sf).store).select(
        "llm_model", "llm_prompt_version", "fingerprint", "llm_output"
    )


def q_near_duplicate_summary(spark, sf):
    return dedup.near_duplicate_summary(_sc(spark, sf).tier2)


def q_constraint_audit(spark, sf):
    sc = _sc(spark, sf)
    return audit.constraint_summary(sc.catalog, sc.final)


def q_request_system_text(spark, sf):
    return resolve.system_lines(_sc(spark, sf).aliases)


def q_request_context(spark, sf):
    return resolve.block_context(_sc(spark, sf).catalog)


def q_spend_estimate(spark, sf):
    return report.spend_estimate(_sc(spark, sf).store)


def q_catalog_list(spark, sf):
    from vinculum.plans.pipeline import list_catalog

    return list_catalog(_sc(spark, sf).catalog)


def q_exact_duplicate_summary_rerun(spark, sf):
    """The exact-duplicate step, given its own output, finds no group and demotes nothing."""
    return dedup.exact_duplicate_summary(_sc(spark, sf).deduped)


def q_documents_exact_duplicates(spark, sf):
    """Exact-duplicate grouping (A2/A4) applied to the driver's documents: whole-text sha256."""
    docs = TB.read_table(spark, sf, "documents").filter(F.col("text").isNotNull())
    return (
        docs.groupBy(F.sha2(F.col("text"), 256).alias("fingerprint"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("survivor"))
        .filter(F.col("n") > 1)
    )


def q_resolver_hook(spark, sf):
    """L2: tier 2 with a Python resolver over Arrow batches (no cache)."""
    sc = _sc(spark, sf)

    def rule(rec: dict) -> str:
        if rec["vintage"] is None:
            raise TimeoutError("resolver timed out")
        if rec["size_ml"] >= 1000:
            return '{"decision":"no_match","confidence":0.6,"candidate_product_ids":[],"reason":"large format"}'
        return (
            '{"decision":"possible_match","confidence":0.9,"candidate_product_ids":[],'
            '"reason":"no candidate named"}'
        )

    st = resolve.resolve_unmatched(
        sc.tier1,
        resolve.function_resolver(rule),
        history=None,
        catalog_ids=sc.catalog.select("product_id"),
        model_id="python-rule",
        run_ts=sc_ts(),
    )
    return st.filter(F.col("llm_source").isNotNull()).select(
        "submission_id", "status", "decision", "matched_product_id", "explanation", "llm_reason", "llm_confidence"
    )


def sc_ts():
    from vinculum.plans.scenario import RUN_TS

    return RUN_TS


def q_json_variant_import(spark, sf):
    return _sc(spark, sf).json_imported.state.select("submission_id", "status", "validation_error", "name", "vintage", "size_ml")


def q_json_array_import(spark, sf):
    """The records as JSON arrays, read in splits: the outcome of each, skipped ones by reason."""
    imp = jsonsrc.array_import_from_tables(spark, sf).written(ST.stage_table, "json-arrays")
    kept = imp.state.select("submission_id", "status", "validation_error", F.lit(1).cast("long").alias("n"))
    gone = imp.skipped().select("submission_id", F.col("reason").alias("status"), F.lit(None).cast("string").alias("validation_error"), "n")
    return kept.unionByName(gone)


def q_json_raw_records(spark, sf):
    """The kept records whole, extra keys included."""
    return _sc(spark, sf).json_imported.state.select("submission_id", "raw_json")


def q_json_rejected_records(spark, sf):
    """Lines that are no record, and records without an id, with their text."""
    return _sc(spark, sf).json_imported.rejected()


def q_json_import_summary(spark, sf):
    return _sc(spark, sf).json_imported.summary()


def q_stream_import(spark, sf):
    return ST.read_store(spark, _sc(spark, sf).streamed).groupBy("import_id", "status").agg(F.count(F.lit(1)).alias("n"))


def q_stream_status_counts(spark, sf):
    """A1 per streamed import as the status stream keeps it; no record is read."""
    return ST.read_status_counts(spark, _sc(spark, sf).streamed)


QUERIES: dict[str, Query] = {
    "catalog_find": q_catalog_find,
    "catalog_uniqueness": q_catalog_uniqueness,
    "missing_id_filter": q_missing_id_filter,
    "duplicate_ids_skipped": q_duplicate_ids_skipped,
    "import_summary": q_import_summary,
    "validate_fields": q_validate_fields,
    "invalid_with_reasons": q_invalid_with_reasons,
    "normalize_names": q_normalize_names,
    "token_sets": q_token_sets,
    "fingerprints": q_fingerprints,
    "exact_duplicate_groups": q_exact_duplicate_groups,
    "exact_duplicate_pairs": q_exact_duplicate_pairs,
    "exact_duplicate_summary": q_exact_duplicate_summary,
    "pending_queue": q_pending_queue,
    "producer_alias": q_producer_alias,
    "category_reject": q_category_reject,
    "candidate_pairs": q_candidate_pairs,
    "candidate_counts": q_candidate_counts,
    "candidate_counts_dense": q_candidate_counts_dense,
    "match_tier1": q_match_tier1,
    "match_tier1_counts": q_match_tier1_counts,
    "match_summary": q_match_summary,
    "unmatched_queue": q_unmatched_queue,
    "request_table": q_request_table,
    "request_candidates": q_request_candidates,
    "request_near_blocks": q_request_near_blocks,
    "decision_cache": q_decision_cache,
    "apply_decisions": q_apply_decisions,
    "apply_decisions_unchecked": q_apply_decisions_unchecked,
    "llm_summary": q_llm_summary,
    "duplicate_propagation": q_duplicate_propagation,
    "near_duplicate_groups": q_near_duplicate_groups,
    "near_duplicate_pairs": q_near_duplicate_pairs,
    "status_counts": q_status_counts,
    "review_queue": q_review_queue,
    "match_results": q_match_results,
    "inspect_submissions": q_inspect_submissions,
    "inspect_import": q_inspect_import,
    "output_datasets": q_output_datasets,
    "final_state": q_final_state,
    "pipeline_report": q_pipeline_report,
    "eval_overall": q_eval_overall,
    "eval_decisions": q_eval_decisions,
    "eval_tiers": q_eval_tiers,
    "eval_by_set": q_eval_by_set,
    "eval_percentages": q_eval_percentages,
    "eval_misses": q_eval_misses,
    "latest_import": q_latest_import,
    "referential_audit": q_referential_audit,
    "drop_import": q_drop_import,
    "revert_import": q_revert_import,
    "json_catalog": q_json_catalog,
    "json_labels": q_json_labels,
    "catalog_append": q_catalog_append,
    "stored_import": q_stored_import,
    "stored_ids": q_stored_ids,
    "stored_answers": q_stored_answers,
    "drift_by_import": q_drift_by_import,
    "confidence_shift": q_confidence_shift,
    "documents_exact_duplicates": q_documents_exact_duplicates,
    "spend_estimate": q_spend_estimate,
    "near_duplicate_summary": q_near_duplicate_summary,
    "cache_table": q_cache_table,
    "constraint_audit": q_constraint_audit,
    "request_context": q_request_context,
    "request_system_text": q_request_system_text,
    "catalog_list": q_catalog_list,
    "exact_duplicate_summary_rerun": q_exact_duplicate_summary_rerun,
    "resolver_hook": q_resolver_hook,
    "json_variant_import": q_json_variant_import,
    "json_array_import": q_json_array_import,
    "json_raw_records": q_json_raw_records,
    "json_rejected_records": q_json_rejected_records,
    "json_import_summary": q_json_import_summary,
    "stream_import": q_stream_import,
    "stream_status_counts": q_stream_status_counts,
}
