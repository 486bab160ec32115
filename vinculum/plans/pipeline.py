"""User-facing composition: one import from records to store, in the fixed stage order.

import -> exact duplicates -> tier 1 -> tier 2 -> propagation -> near-duplicate sweep ->
report.  The import, exact-duplicate, tier-1 and tier-2 states are cut into stage tables under the session's
checkpoint folder; the final rows of the import are written to the store's ``import_id``
partition (dynamic overwrite, so a re-run replaces only this import), its ids and answers
beside it, and last its commit marker: until then nothing of the import is seen.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum import schemas as S
from vinculum.functions.text import percent
from vinculum.operators import dedup, ingest, match, report, resolve
from vinculum.operators import evaluate as E
from vinculum.session import path_exists
from vinculum.sources import store as ST


@dataclass
class ImportResult:
    import_id: str
    imported: ingest.Imported
    final: DataFrame  # working state of the import after every stage

    def report(self) -> DataFrame:
        return report.pipeline_report(self.imported, self.final)

    def outputs(self) -> dict[str, DataFrame]:
        return outputs(self.final, self.imported)


def default_cache_path(store_path: str) -> str:
    """Folder of the tier-2 cache table that belongs to a store."""
    return ST.answers_path(store_path)


def run_import(
    spark: SparkSession,
    records: DataFrame,
    catalog: DataFrame | match.CatalogIndex,
    aliases: DataFrame,
    *,
    import_id: str,
    run_ts: _dt.datetime,
    resolver: resolve.Resolver | None = None,
    store_path: str | None = None,
    variant: bool = False,
    model_id: str = S.DEFAULT_MODEL,
    catalog_ids: DataFrame | None = None,
    cache_path: str | None = None,
) -> ImportResult:
    """Run one import.  ``records`` as for :func:`ingest.import_records`.

    ``catalog`` is a :class:`match.CatalogIndex` (build it once with a path) or a catalog, which
    is indexed for this run.  With ``store_path``, ids stored by earlier imports are skipped by
    a look-up in the store's id index, stored answers serve as the tier-2 cache (an append-only
    table, ``cache_path``, beside the store by default), and the final rows are written to the
    store.  Without ``resolver`` the unmatched rows stay ``unmatched`` (tier 1 only).
    """
    if not isinstance(catalog, match.CatalogIndex):
        catalog = match.build_index(catalog)
    if store_path and cache_path is None:
        cache_path = default_cache_path(store_path)
    if store_path:
        ST.begin_import(spark, store_path, import_id, cache_path)
    cache = ST.read_answers(spark, store_path, cache_path) if cache_path else None
    imp, seen = ingest.import_records(records, import_id, run_ts, variant=variant), None
    if store_path and path_exists(spark, ST.ids_path(store_path)):
        # the ids asked for come from the written records, whose texts needn't be parsed for it
        seen = imp.records_written(ST.stage_table, import_id)
        stored = ST.stored_among(seen[0], ST.ids_path(store_path), import_id, store_path)
        imp = ingest.import_records(records, import_id, run_ts, variant=variant, stored_ids=stored)
    imp = imp.written(ST.stage_table, import_id, seen)
    work = ST.stage_state(dedup.mark_exact_duplicates(imp.state), f"{import_id}-deduped")
    pending = ST.stage_state(match.pending_signatures(work, aliases), f"{import_id}-pending")
    tier1 = lambda rows: match.match_tier1(rows, catalog, aliases, run_ts, pending=pending)
    work = ST.stage_changed(work, F.col("status") == "pending", tier1, f"{import_id}-tier1", ST.stage_state)
    if resolver is not None:
        if catalog_ids is None:
            catalog_ids = catalog.cat.select("product_id")
        answered = lambda rows: resolve.resolve_unmatched(
            rows, resolver, history=None, cache=cache, catalog_ids=catalog_ids, model_id=model_id, run_ts=run_ts,
        )
        work = ST.stage_changed(work, F.col("status") == "unmatched", answered, f"{import_id}-resolved", ST.stage_state)
    rest = work.filter("status is null or status <> 'exact_duplicate'")
    work = ST.stage_changed(work, F.col("status") == "exact_duplicate", lambda dups: dedup.with_survivors(dups, rest), f"{import_id}-tier2", ST.stage_state)
    final = ST.stage_changed(work, F.col("status") == "matched", dedup.mark_near_duplicates, f"{import_id}-final", ST.stage_state)
    if store_path:
        ST.write_import(final.drop("position"), store_path, import_id)
        ST.write_ids(final, ST.ids_path(store_path), import_id)
        ST.write_status_counts(final, store_path, import_id)
    if cache_path and resolver is not None:
        ST.write_answers(resolve.new_cache_entries(final, cache), cache_path, import_id)
    if store_path:
        ST.commit_import(spark, store_path, import_id, run_ts)
    return ImportResult(import_id=import_id, imported=imp, final=final)


def list_catalog(catalog: DataFrame) -> DataFrame:
    """The catalog ordered by product id."""
    return catalog.select(*[f.name for f in S.CATALOG_SCHEMA.fields]).orderBy("product_id")


def outputs(state: DataFrame, imported: ingest.Imported | None = None) -> dict[str, DataFrame]:
    """The output datasets of an import, with ``imported`` also its report and what was skipped."""
    st = F.col("status")
    out = {
        "valid_records": state.filter(st != "invalid"),
        "invalid_records": report.invalid_with_reasons(state),
        "exact_duplicate_records": report.exact_duplicate_pairs(state),
        "near_duplicate_records": report.near_duplicate_pairs(state),
        "unmatched_records": state.filter(st.isin("unmatched", "no_match", "review")),
    }
    if imported is not None:
        out["summary_report"] = report.pipeline_report(imported, state)
        out["skipped_records"] = imported.skipped()
        out["rejected_records"] = imported.rejected()
    return out


def output_counts(state: DataFrame) -> DataFrame:
    """Rows of each output dataset of a state: (dataset, n)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n") for name, df in outputs(state).items()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def write_lists(lists: dict[str, DataFrame], folder: str) -> dict[str, tuple[str, int]]:
    """Write each list whole as a dataset below ``folder``: name -> (path, rows)."""
    out = {}
    for name, rows in lists.items():
        path = f"{folder.rstrip('/')}/{name}"
        rows.write.mode("overwrite").parquet(path)
        out[name] = (path, rows.sparkSession.read.parquet(path).count())
    return out


def _print_lists(written: dict[str, tuple[str, int]]) -> None:
    for name, (path, n) in written.items():
        print(f"{n:>12,} rows  {name.replace('_', ' ')}: {path}")


def print_report(report_df: DataFrame, lists: dict[str, DataFrame] | None = None, folder: str | None = None) -> None:
    """The pipeline report (of fixed size) on the console.

    ``lists`` are written whole below ``folder``; the console names each with its size and place.
    """
    by_section: dict[str, list[str]] = {}
    for r in report_df.collect():
        by_section.setdefault(r["section"], []).append(f"{r['metric']} {r['value']:,}")
    for section, parts in by_section.items():
        print(f"[{section}] " + " | ".join(parts))
    if lists:
        if folder is None:
            raise ValueError("lists need a folder")
        _print_lists(write_lists(lists, folder))


def print_eval_report(scored: DataFrame, folder: str) -> None:
    """R2: the evaluation on the console, one line per figure; all misses go to ``folder``."""
    total = E.overall(scored).select(
        "total", "not_found", "false_positives",
        percent(F.col("pid_correct"), F.col("total")).alias("product"),
        percent(F.col("decision_correct"), F.col("total")).alias("decision"),
    ).first()
    print(f"{total['total']} labels: product right {total['product']}, decision right {total['decision']}, "
          f"wrong product accepted {total['false_positives']}, without a record {total['not_found']}")
    tier = E.tiers(scored).first()
    spread = "" if tier["conf_mean"] is None else f", confidence {tier['conf_min']} to {tier['conf_max']}, mean {tier['conf_mean']}"
    print(f"settled by rules {tier['tier1']}, by the model {tier['tier2']}{spread}")
    print("decisions: " + ", ".join(f"{r['emitted']} {r['n']}" for r in E.decisions_histogram(scored).collect()))
    sets = E.by_acceptable_set(scored).withColumn("share", percent(F.col("correct"), F.col("n")))
    for r in sets.collect():
        print(f"accepting {r['class_key']}: {r['share']} of {r['n']}")
    _print_lists(write_lists({"misses": E.misses(scored)}, folder))
