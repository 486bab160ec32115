"""One import run over the driver tables, stage by stage.

The import, exact-duplicate, tier-1, tier-2 and final states (and the small catalog-side tables) are
written once as stage tables (``sources.store.stage_table``) in this process's own folder and read
back, so later stages start from a file scan.  Tier 1, tier 2 and the near-duplicate sweep write the
rows that they can change; the others stay in the table before (``stage_changed``).  No table of
states holds fingerprints, which follow from the fields (``stage_state``).  A scenario is memoised per (session, input folder): the registered queries of
one process share its stage tables, and no other process reads them.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum import schemas as S
from vinculum.operators import dedup, ingest, match, resolve
from vinculum.sources import tables as TB
from vinculum.sources.store import stage_changed, stage_state, stage_table

IMPORT_ID = "import-0001"
HISTORY_IMPORT_ID = "import-0000"
RUN_TS = _dt.datetime(2026, 1, 1, 0, 0, 0)
HISTORY_CREATED = _dt.datetime(2025, 1, 1, 0, 0, 0)


class Scenario:
    """Catalog, records, and the state after each stage of one import.

    ``partitions`` deals the record scan out where the input files give too few splits.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        *,
        model_id: str = S.DEFAULT_MODEL,
        materialize: bool = True,
        partitions: int | None = None,
    ):
        self.spark = spark
        self.sf_dir = sf_dir
        self.model_id = model_id
        self.materialize = materialize
        self.partitions = partitions

    def _mat(self, df: DataFrame, name: str) -> DataFrame:
        return stage_table(df, name) if self.materialize else df

    def _mat_state(self, df: DataFrame, name: str) -> DataFrame:
        return stage_state(df, name) if self.materialize else df

    def _changed(self, state: DataFrame, status: str, step: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
        return stage_changed(state, F.col("status") == status, step, name, stage_state) if self.materialize else step(state)

    # --- inputs -------------------------------------------------------------------------
    @cached_property
    def catalog(self) -> DataFrame:
        return self._mat(TB.catalog(self.spark, self.sf_dir), "catalog")

    @cached_property
    def index(self) -> match.CatalogIndex:
        """Tokens, exploded tokens, token frequencies and block counts of the catalog."""
        return match.build_index(self.catalog)

    @cached_property
    def aliases(self) -> DataFrame:
        return self._mat(TB.aliases(self.spark, self.sf_dir), "aliases")

    @cached_property
    def raw(self) -> DataFrame:
        return TB.raw_submissions(self.spark, self.sf_dir, self.partitions)

    @cached_property
    def labels(self) -> DataFrame:
        return self._mat(TB.labels(self.spark, self.sf_dir, self.partitions), "labels")

    # --- stages ---------------------------------------------------------------------------
    @cached_property
    def imported(self) -> ingest.Imported:
        imp = ingest.import_records(self.raw, IMPORT_ID, RUN_TS)
        return imp.written(stage_table) if self.materialize else imp

    @cached_property
    def json_imported(self) -> ingest.Imported:
        """The same records written as JSON lines and imported from there."""
        from vinculum.sources import jsonsrc

        imp = jsonsrc.json_import_from_tables(self.spark, self.sf_dir)
        return imp.written(stage_table, "json") if self.materialize else imp

    @cached_property
    def work(self) -> DataFrame:
        """The imported rows without the immutable raw record and input position.

        Those stay in the import table (the raw layer, joinable by submission_id); the later
        stages shuffle and rewrite only the columns they can change or need.
        """
        return self.imported.state.drop("raw_json", "position")

    @cached_property
    def deduped(self) -> DataFrame:
        # written once: the pending rows and tier 1 are two jobs, and each would shuffle all rows
        # by fingerprint again
        return self._mat_state(dedup.mark_exact_duplicates(self.work), "deduped")

    @cached_property
    def pending(self) -> DataFrame:
        """Pending rows with their signatures, which tier 1 and the candidate queries read several times."""
        return self._mat_state(match.pending_signatures(self.deduped, self.aliases), "pending")

    @cached_property
    def tier1(self) -> DataFrame:
        return self._changed(
            self.deduped, "pending", lambda rows: match.match_tier1(rows, self.index, self.aliases, RUN_TS, pending=self.pending), "tier1"
        )

    @cached_property
    def decisions(self) -> DataFrame:
        un = self.tier1.filter(F.col("status") == "unmatched")
        return self._mat(TB.decisions_for(un, self.catalog), "decisions")

    @cached_property
    def history(self) -> DataFrame:
        """An earlier import holding half of the unmatched fingerprints with two stored answers
        (older and newer), plus answers under another prompt version."""
        un = self.tier1.filter(F.col("status") == "unmatched")
        rows = (
            TB.history_rows(un)
            .withColumn("import_id", F.lit(HISTORY_IMPORT_ID))
            .withColumn("created_at", F.lit(HISTORY_CREATED).cast("timestamp"))
        )
        decisions = TB.decisions_for(rows, self.catalog, F.col("h_shift"), keys=("fingerprint", "submission_id"))
        out = resolve.resolve_unmatched(
            rows,
            resolve.table_resolver(decisions, keys=("fingerprint", "submission_id")),
            history=None,
            catalog_ids=self.catalog.select("product_id"),
            model_id=self.model_id,
            run_ts=F.col("h_ts"),
            prompt_version=F.col("h_version"),
        ).drop("h_shift", "h_ts", "h_version")
        return self._mat_state(out, "history")

    def _resolved(self, rows: DataFrame, null_candidate_to_review: bool) -> DataFrame:
        return resolve.resolve_unmatched(
            rows,
            resolve.table_resolver(self.decisions),
            history=self.history,
            catalog_ids=self.catalog.select("product_id"),
            model_id=self.model_id,
            run_ts=RUN_TS,
            null_candidate_to_review=null_candidate_to_review,
        )

    @cached_property
    def tier2(self) -> DataFrame:
        # the answers, the copies, the sweep and the summaries read each part several times
        st = self._changed(self.tier1, "unmatched", lambda rows: self._resolved(rows, True), "resolved")
        if not self.materialize:
            return dedup.propagate_to_duplicates(st)
        rest = st.filter("status is null or status <> 'exact_duplicate'")
        return self._changed(st, "exact_duplicate", lambda dups: dedup.with_survivors(dups, rest), "tier2")

    @cached_property
    def tier2_unchecked(self) -> DataFrame:
        """Tier 2 that applies a confident answer whatever product it names (H6 flag off)."""
        return dedup.propagate_to_duplicates(self._resolved(self.tier1, False))

    @cached_property
    def final(self) -> DataFrame:
        return self._changed(self.tier2, "matched", dedup.mark_near_duplicates, "final")

    @cached_property
    def streamed(self) -> str:
        """Path of the store that two deliveries of the records were streamed into."""
        from vinculum.streaming.stream_import import deliver_tables

        return deliver_tables(self)

    @cached_property
    def store(self) -> DataFrame:
        """Every stored import: the history import and this one."""
        return self.history.unionByName(self.final)


_SCENARIOS: dict[tuple[int, str], Scenario] = {}


def scenario(spark: SparkSession, sf_dir: str) -> Scenario:
    """The memoised scenario of the registered queries of this process."""
    key = (id(spark), sf_dir.rstrip("/"))
    if key not in _SCENARIOS:
        _SCENARIOS[key] = Scenario(spark, sf_dir)
    return _SCENARIOS[key]
