"""Tier 1, dedup sweeps and tier 2 on small inline catalogs (one scenario per test)."""

from __future__ import annotations

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import RUN_TS
from vinculum import schemas as S
from vinculum.operators import dedup, ingest, match, resolve
from vinculum.sources.store import stage_table

CATALOG = "product_id string, canonical_name string, producer string, category string, size_ml int, vintage_required boolean"
RECORD = "submission_id string, name string, producer string, category string, vintage int, size_ml int, position long"
OTHER_NAMES = [("casa norte", "Casa del Norte"), ("k&b", "Kell and Byrne")]


def catalog(spark, *rows):
    """Rows (id, name[, producer, category, size, needs vintage])."""
    defaults = (None, None, "Casa del Norte", "Tequila", 700, False)
    return spark.createDataFrame([(*r, *defaults[len(r):]) for r in rows], CATALOG)


def records(spark, *rows):
    """Rows (id, name[, producer, category, vintage, size])."""
    defaults = (None, None, "Casa del Norte", "Tequila", 1999, 700)
    return spark.createDataFrame([(*r, *defaults[len(r):], i) for i, r in enumerate(rows)], RECORD)


def tier1(spark, cat, recs, **options):
    names = spark.createDataFrame(OTHER_NAMES, "alias string, canonical string")
    state = stage_table(dedup.mark_exact_duplicates(ingest.import_records(recs, "imp", RUN_TS).state), "test")
    return stage_table(match.match_tier1(state, cat, names, RUN_TS, **options), "test")


def by_id(state):
    return {r.submission_id: r for r in state.collect()}


def test_one_product_in_any_spelling(spark):
    cat = catalog(spark, ("A1", "Reposado Azul 12"), ("B1", "Harbour Peated", "Kell and Byrne", "Whisky", 500))
    got = by_id(tier1(spark, cat, records(
        spark, ("r1", "Reposado Azul 12"), ("r2", "azul, REPOSADO-12", " Casa Norte\t"), ("r3", "peated", "K&B", "Whisky", None, 500))))
    assert {k: (r.status, r.decision, r.matched_product_id) for k, r in got.items()} == {
        "r1": ("matched", "exact_match", "A1"), "r2": ("matched", "exact_match", "A1"), "r3": ("matched", "exact_match", "B1")}


def test_out_of_scope_unknown_producer_and_foreign_token(spark):
    cat = catalog(spark, ("A1", "Reposado Azul"))
    got = by_id(tier1(spark, cat, records(
        spark, ("r1", "Reposado Azul", "Casa del Norte", "Cider"), ("r2", "Reposado Azul", "Nobody"), ("r3", "Reposado Azul Viejo"))))
    assert (got["r1"].status, got["r1"].decision, got["r1"].explanation) == ("no_match", "no_match", "category_mismatch")
    assert (got["r2"].status, got["r2"].decision) == ("unmatched", None)
    assert got["r3"].status == "unmatched"


def test_several_candidates_and_sizes(spark):
    cat = catalog(
        spark, ("A1", "Cedro Blanco Uno"), ("A2", "Cedro Blanco Dos"), ("A3", "Piedra Lisa", "Casa del Norte", "Tequila", 1000),
        ("A4", "Doble Sol", "Casa del Norte", "Tequila", 1000), ("A5", "Doble Sol", "Casa del Norte", "Tequila", 3000))
    got = by_id(tier1(spark, cat, records(
        spark, ("r1", "Blanco Dos"), ("r2", "Cedro"), ("r3", "Piedra Lisa"), ("r4", "Doble Sol"), ("r5", "?!"))))
    assert got["r1"].matched_product_id == "A2"
    assert (got["r2"].status, got["r2"].matched_product_id, got["r2"].explanation) == ("review", None, "multiple_candidates")
    assert (got["r3"].status, got["r3"].explanation) == ("no_match", "size_ml_mismatch")
    assert got["r4"].status == "unmatched"  # the name exists in two other sizes
    assert (got["r5"].status, got["r5"].explanation) == ("review", "multiple_candidates")  # no tokens: the whole block
    strict = by_id(tier1(spark, cat, records(spark, ("r5", "?!")), require_tokens=True))
    assert strict["r5"].status == "unmatched"


def test_vintage_required(spark):
    cat = catalog(spark, ("A1", "Gran Reserva", "Casa del Norte", "Wine", 750, True))
    rec = ("Gran Reserva", "Casa del Norte", "Wine")
    got = by_id(tier1(spark, cat, records(spark, ("r1", *rec, None, 750), ("r2", *rec, 1988, 750))))
    assert (got["r1"].status, got["r1"].matched_product_id, got["r1"].explanation) == ("review", "A1", "vintage_required_missing")
    assert (got["r2"].status, got["r2"].matched_product_id) == ("matched", "A1")


def test_copies_propagation_sweep_and_reruns(spark):
    cat = catalog(spark, ("A1", "Lluvia"))
    raw = stage_table(ingest.import_records(records(spark, ("r9", "Lluvia"), ("r4", "Lluvia"), ("r6", "LLUVIA")), "imp", RUN_TS).state, "test")
    assert [tuple(r) for r in dedup.exact_duplicate_summary(raw).collect()] == [(1, 1)]
    once = stage_table(dedup.mark_exact_duplicates(raw), "test")
    assert [tuple(r) for r in dedup.exact_duplicate_summary(once).collect()] == [(0, 0)]
    assert by_id(dedup.mark_exact_duplicates(once)) == by_id(once)
    names = spark.createDataFrame(OTHER_NAMES, "alias string, canonical string")
    state = stage_table(dedup.propagate_to_duplicates(match.match_tier1(once, cat, names, RUN_TS)), "test")
    assert [tuple(r) for r in dedup.near_duplicate_summary(state).collect()] == [(1, 1)]
    swept = stage_table(dedup.mark_near_duplicates(state), "test")
    got = by_id(swept)
    assert (got["r9"].status, got["r9"].duplicate_of, got["r9"].matched_product_id) == ("exact_duplicate", "r4", "A1")
    assert (got["r6"].status, got["r6"].duplicate_of, got["r4"].status) == ("near_duplicate", "r4", "matched")
    assert [tuple(r) for r in dedup.near_duplicate_summary(swept).collect()] == [(0, 0)]
    assert by_id(dedup.mark_near_duplicates(swept)) == got


def test_review_rows_never_cluster(spark):
    cat = catalog(spark, ("A1", "Gran Reserva", "Casa del Norte", "Wine", 750, True))
    state = tier1(spark, cat, records(spark, ("r1", "Gran", "Casa del Norte", "Wine", None, 750), ("r2", "Reserva", "Casa del Norte", "Wine", None, 750)))
    assert {r.status for r in dedup.mark_near_duplicates(state).collect()} == {"review"}


def test_index_is_built_once(spark, tmp_path):
    cat = catalog(spark, ("A1", "Lluvia"), ("A2", "Lluvia Fina"))
    match.build_index(cat, str(tmp_path / "index"))
    index = match.read_index(spark, str(tmp_path / "index"))
    assert by_id(tier1(spark, index, records(spark, ("r1", "Fina"))))["r1"].matched_product_id == "A2"
    names = spark.createDataFrame(OTHER_NAMES, "alias string, canonical string")
    out = match.match_tier1(ingest.import_records(records(spark, ("r1", "Fina")), "imp", RUN_TS).state, index, names, RUN_TS)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(p_tokens" not in plan  # the catalog's tokens are read, not exploded again


def answer(decision, confidence, ids, reason="because"):
    return json.dumps({"decision": decision, "confidence": confidence, "candidate_product_ids": ids, "reason": reason})


ANSWERS = {
    "u0": (answer("possible_match", 0.85, ["A1"]), None),
    "u1": (answer("possible_match", 0.8499, ["A1"]), None),
    "u2": (answer("exact_match", 0.99, ["A1"]), None),
    "u3": (answer("no_match", 0.1, []), None),
    "u4": (None, "TimeoutError: slow"),
    "u5": ("not json", None),
    "u6": (answer("possible_match", 0.9, []), None),
    "u7": (answer("possible_match", 0.9, ["NOWHERE"]), None),
}


def undecided(spark, n):
    cat = catalog(spark, ("A1", "Lluvia"))
    return cat, tier1(spark, cat, records(spark, *[(f"u{i}", f"strange {'x' * i}", "Casa del Norte", "Tequila", 1990 if i % 2 else None) for i in range(n)]))


def resolved(spark, cat, state, resolver, **options):
    return resolve.resolve_unmatched(state, resolver, history=options.pop("history", None), catalog_ids=cat.select("product_id"),
                                     model_id="m", run_ts=RUN_TS, **options)


def test_answers_cache_and_errors(spark):
    cat, state = undecided(spark, len(ANSWERS))
    prints = {r.submission_id: r.fingerprint for r in state.collect()}
    table = spark.createDataFrame([(prints[k], *v) for k, v in ANSWERS.items()], "fingerprint string, llm_output string, llm_error string")
    out = resolved(spark, cat, state, resolve.table_resolver(table))
    got = by_id(out)
    view = {k: (r.status, r.decision, r.matched_product_id, r.explanation) for k, r in got.items()}
    assert view == {
        "u0": ("matched", "possible_match", "A1", "llm_possible_match"),
        "u1": ("review", "human_review", "A1", "llm_human_review"),
        "u2": ("matched", "possible_match", "A1", "llm_possible_match"),  # never above possible_match
        "u3": ("no_match", "no_match", None, "llm_no_match"),
        "u4": ("review", "human_review", None, "llm_unavailable"),
        "u5": ("review", "human_review", None, "llm_unavailable"),
        "u6": ("review", "human_review", None, "llm_human_review"),
        "u7": ("review", "human_review", None, "llm_human_review"),
    }
    assert got["u4"].llm_reason == "TimeoutError: slow" and got["u4"].llm_output is None
    assert got["u4"].llm_prompt_version == S.PROMPT_VERSION
    unchecked = by_id(resolved(spark, cat, state, resolve.table_resolver(table), null_candidate_to_review=False))
    assert (unchecked["u6"].status, unchecked["u6"].matched_product_id) == ("matched", None)
    assert (unchecked["u7"].status, unchecked["u7"].matched_product_id) == ("matched", "NOWHERE")

    def never(record):
        raise RuntimeError("asked")

    again = by_id(resolved(spark, cat, state, resolve.function_resolver(never), history=out.withColumn("import_id", F.lit("old"))))
    assert (again["u0"].llm_source, again["u0"].status) == ("cache", "matched")
    assert (again["u4"].llm_source, again["u4"].llm_reason) == ("error", "RuntimeError: asked")


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_resolver_gets_plain_values_whatever_the_batch(spark, batch):
    """Nulls are None and integers ints, alone or beside other values in a batch."""
    cat, state = undecided(spark, 8)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        def describe(record):
            return answer("human_review", 0.5, [], repr(sorted(record.items())))

        got = by_id(resolved(spark, cat, state.coalesce(1), resolve.function_resolver(describe, concurrency=3)))
    finally:
        spark.conf.set(key, before)
    for i in range(8):
        assert got[f"u{i}"].llm_reason == repr([("category", "Tequila"), ("name", f"strange {'x' * i}".strip()), ("producer", "Casa del Norte"),
                                                ("size_ml", 700), ("submission_id", f"u{i}"), ("vintage", 1990 if i % 2 else None)])


def test_resolver_tries_again(spark):
    cat, state = undecided(spark, 1)
    calls = spark.sparkContext.accumulator(0)

    def flaky(record):
        calls.add(1)
        raise ValueError("no")

    got = by_id(resolved(spark, cat, state, resolve.function_resolver(flaky, attempts=3)))
    assert got["u0"].llm_reason == "ValueError: no" and calls.value == 3


def test_context_of_other_names_and_misspelt_producers(spark):
    cat = catalog(spark, ("A1", "Cedro Blanco"), ("A2", "Cedro Negro"), ("W1", "Cedro Blanco", "Casa del Norte", "Wine"),
                  ("B1", "Blanco", "Otra Casa"))
    names = spark.createDataFrame(OTHER_NAMES, "alias string, canonical string")
    state = tier1(spark, cat, records(spark, ("r1", "Cedro Rojo", "casa norte"), ("r2", "Cedro Blnco", "Csa del Nrte"), ("r3", "zzz", "qqq")))
    got = by_id(resolve.request_table(state, cat, names))
    assert (got["r1"].block_producer, got["r1"].block_products, got["r1"].found_products) == ("casa del norte", 2, 0)
    assert (got["r2"].block_products, got["r2"].found_products) == (0, 2)
    assert (got["r3"].block_products, got["r3"].found_products) == (0, 0)  # nothing in the category shares a token
    found = sorted((r.submission_id, r["rank"], r.product_id, r.shared) for r in resolve.request_candidates(state, cat, names).collect())
    assert found == [("r2", 1, "A1", 2), ("r2", 1, "A2", 2)]  # a tie


def test_the_search_lists_every_product_with_a_rare_token(spark):
    rows = [(f"T{i:02}", f"Cedro Rojo {i}") for i in range(30)] + [(f"F{i:03}", f"Filler {i}") for i in range(1000)] + [("Z1", "Zafiro Uno")]
    cat = catalog(spark, *rows)
    names = spark.createDataFrame(OTHER_NAMES, "alias string, canonical string")
    state = tier1(spark, cat, records(spark, ("r1", "Cedro Zafiro", "Nobody"), ("r2", "Filler Cedro", "Nobody"), ("r3", "del norte", "Nobody")))
    found = resolve.request_candidates(state, cat, names)
    by_row = {k: sorted((r["rank"], r.product_id) for r in found.filter(found.submission_id == k).collect()) for k in ("r1", "r2", "r3")}
    assert by_row["r1"] == [(1, "Z1"), *[(2, f"T{i:02}") for i in range(30)]]  # the rarer token first, ties kept
    assert by_row["r2"] == [(1, f"T{i:02}") for i in range(30)]  # the common token is no prefix
    assert len(by_row["r3"]) == 1031  # no rare token: the rarest known ones


def _broadcasts_of_exploded_rows(df) -> int:
    """Broadcasts in the executed plan of a collected DataFrame that hold exploded rows."""
    found, todo = 0, [(df._jdf.queryExecution().executedPlan(), False)]
    while todo:
        node, sent = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append((node.executedPlan(), sent))
        elif name.endswith("QueryStageExec"):
            todo.append((node.plan(), sent))
        found += sent and name == "GenerateExec"
        # an aggregate's or a shuffle's rows are measured, those of an explode are not
        sent = name == "BroadcastExchangeExec" or (sent and name not in ("ShuffleExchangeExec", "BroadcastExchangeExec"))
        children = node.children()
        todo += [(children.apply(i), sent) for i in range(children.size())]
    return found


def test_requests_broadcast_no_exploded_sets_and_count_without_pairs(spark):
    """Products of equal tokens are searched as one set; no exploded side goes through the driver."""
    cat = catalog(spark, *[(f"P{i:04}", f"Cedro Rojo {i % 3}") for i in range(600)], ("Z1", "Zafiro Uno"), ("Z2", "Zafiro Uno"))
    names = spark.createDataFrame(OTHER_NAMES, "alias string, canonical string")
    asked = [(f"r{i}", f"Cedro {i % 3} x{i}", "Nobody") for i in range(30)] + [("z", "Zafiro Dos 2", "Nobody")]
    state = tier1(spark, cat, records(spark, *asked))
    table, pairs = resolve.request_table(state, cat, names), resolve.request_candidates(state, cat, names)
    counted = {r.submission_id: r.found_products for r in table.collect()}
    listed: dict[str, list] = {}
    for r in pairs.collect():
        listed.setdefault(r.submission_id, []).append((r["rank"], r.product_id))
    assert counted == {k: len(v) for k, v in listed.items()} == {**{f"r{i}": 200 for i in range(30)}, "z": 2}
    assert {rank for v in listed.values() for rank, _ in v} == {1}
    assert _broadcasts_of_exploded_rows(table) == _broadcasts_of_exploded_rows(pairs) == 0
    found = resolve._found_sets(resolve._asked(state, cat, names), cat)
    assert found.count() == 31  # a row per pair of sets, not per product


def test_misspelt_producers_find_their_blocks(spark):
    cat = catalog(spark, ("A1", "Uno", "Brand#12"), ("A2", "Dos", "Brand#12"), ("B1", "Tres", "Brand#13"), ("C1", "Uno", "Other House"), ("W1", "Uno", "Brand#12", "Wine"))
    names = spark.createDataFrame(OTHER_NAMES, "alias string, canonical string")
    state = tier1(spark, cat, records(spark, ("r1", "zz", "Brnd 12"), ("r2", "zz", "brannd--13"), ("r3", "zz", "Bnd 12"), ("r4", "zz", "Ohter House"), ("r5", "zz", "xy")))
    near = {(r.submission_id, r.block_producer, r.distance, r.block_products) for r in resolve.near_blocks(state, cat, names).collect()}
    assert near == {("r1", "brand#12", 1, 2), ("r1", "brand#13", 2, 1), ("r2", "brand#13", 1, 1), ("r2", "brand#12", 2, 2), ("r3", "brand#12", 2, 2), ("r4", "other house", 2, 1)}
    assert {r.submission_id: r.near_blocks for r in resolve.request_table(state, cat, names).collect()} == {"r1": 2, "r2": 2, "r3": 1, "r4": 1, "r5": 0}


def test_deletion_variants_meet_exactly_within_the_distance(spark):
    import random

    rng = random.Random(7)
    words = ["".join(rng.choices("abc", k=rng.randint(0, 6))) for _ in range(40)]
    df = spark.createDataFrame([(w,) for w in set(words)], "w string")
    v = df.select("w", F.explode(resolve._deletions(F.col("w"), 2)).alias("v"))
    pairs = v.join(v.withColumnRenamed("w", "x"), "v").select("w", "x", F.levenshtein("w", "x").alias("d")).filter("d <= 2").distinct()
    every = df.crossJoin(df.withColumnRenamed("w", "x")).select("w", "x", F.levenshtein("w", "x").alias("d")).filter("d <= 2")
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, every.collect()))


def _shuffled_rows(df) -> int:
    """Rows that the executed plan of a collected DataFrame wrote to its shuffles."""
    seen, rows, todo = set(), 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if name == "ShuffleExchangeExec" and node.id() not in seen:
            seen.add(node.id())
            rows += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows


def test_counts_of_dense_tokens_need_no_pairs(spark):
    """Every product of the block has the same two tokens; the counts come from bitmaps."""

    def products(n):
        rows = [(f"P{i:06d}", f"Azul Reposado k{i % 7} s{i}", "Casa del Norte", "Tequila", (500, 700, 1000)[i % 3], i % 2 == 0) for i in range(n)]
        return [*rows, ("Q1", "Azul Reposado k1", "Otra Casa", "Tequila", 700, False)]

    wanted = [("casa del norte", "Tequila", size, norm) for size in (500, 700, 900) for norm in
              ("azul", "reposado azul", "k3 azul", "k1 k2", "s5 azul", "s1 s2", "azul zz", "")]
    wanted += [("otra casa", "Tequila", 700, "azul"), ("nobody", "Tequila", 700, "azul")]

    def by_hand(rows):
        out = {}
        for sig in wanted:
            words = set(sig[3].split())
            hits = [r for r in rows if r[2].lower() == sig[0] and words <= set(r[1].lower().split())]
            at = sorted((r[0], r[5]) for r in hits if r[4] == sig[2])
            if hits:
                out[sig] = (len(at), len(hits), at[0] if at else None)
        return out

    for n in (1500, 6000):
        sigs = spark.createDataFrame(wanted, "producer_key string, category string, size_ml int, norm string")
        rows = products(n)
        index = match.build_index(catalog(spark, *rows), dense=100)
        found = match.candidate_counts(sigs, index)
        got = {tuple(r[:4]): (r.n_at_size or 0, r.n_any, tuple(r.first_at) if r.first_at else None) for r in found.collect() if r.n_any}
        assert got == by_hand(rows)
        tokens_only = match.candidate_counts(sigs.filter("norm in ('azul', 'reposado azul', 'k3 azul')"), index)
        tokens_only.collect()
        # the token frequencies of the block (one row a product here) and a few bitmaps are moved,
        # not the six candidates a product
        assert _shuffled_rows(tokens_only) < n + 200


def test_dense_counts_across_buckets(spark):
    """Ordinals of one block in several bitmaps of 32,768; the first product lies in a later one."""
    cat = spark.range(80_000).select(
        F.format_string("P%06d", "id").alias("product_id"), F.lit("Azul").alias("canonical_name"), F.lit("Casa").alias("producer"),
        F.lit("Tequila").alias("category"), F.when(F.col("id") == 77_777, 700).otherwise(500).cast("int").alias("size_ml"), F.lit(True).alias("vintage_required"))
    sigs = spark.createDataFrame([("casa", "Tequila", 700, "azul"), ("casa", "Tequila", 500, "azul")], "producer_key string, category string, size_ml int, norm string")
    got = {r.size_ml: (r.n_at_size, r.n_any, tuple(r.first_at)) for r in match.candidate_counts(sigs, match.build_index(cat)).collect()}
    assert got == {700: (1, 80_000, ("P077777", True)), 500: (79_999, 80_000, ("P000000", True))}


def test_search_runs_among_token_sets(spark):
    """Products of the same words, and names of the same words, add nothing to the search."""
    three = [("Roble", 500), ("Roble Viejo", 700), ("Viejo Roble", 700)]
    cat = catalog(spark, *[(f"P{i:04}", three[i % 3][0], "Casa", "Rum", three[i % 3][1], i == 1) for i in range(900)])
    index = match.build_index(cat)
    assert index.postings is None  # two token sets, though each token is in 600 products or more
    assert {(r.token, r.df) for r in index.freq.collect()} == {("roble", 2), ("viejo", 1)}
    assert index.ctok.count() == 3  # not 1,500, a row per product and token
    norms = ["roble", "roble viejo", "viejo roble", "roble nuevo", ""]
    sigs = spark.createDataFrame([("casa", "Rum", size, n) for size in (500, 700, 900) for n in norms], "producer_key string, category string, size_ml int, norm string")
    got = {(r.size_ml, r.norm): (r.n_at_size or 0, r.n_any, r.first_at and tuple(r.first_at)) for r in match.candidate_counts(sigs, index).collect()}
    whole, viejo = {500: (300, 900, ("P0000", False)), 700: (600, 900, ("P0001", True)), 900: (0, 900, None)}, {500: (0, 600, None), 700: (600, 600, ("P0001", True)), 900: (0, 600, None)}
    assert got == {(size, n): found[size] for size in (500, 700, 900) for n, found in (("roble", whole), ("", whole), ("roble viejo", viejo), ("viejo roble", viejo))}
    names = spark.createDataFrame(OTHER_NAMES, "alias string, canonical string")
    asked = [("a", "Roble", 500), ("b", "viejo, roble", 700), ("c", "Roble Viejo", 1000), ("d", "Roble Nuevo", 700)]
    state = ingest.import_records(records(spark, *[(i, n, "Casa", "Rum", 2000, size) for i, n, size in asked]), "imp", RUN_TS).state
    pairs = match.row_candidate_pairs(state, index, names).groupBy("submission_id", "at_size").agg(F.countDistinct("product_id").alias("n"), F.count("*").alias("rows"))
    assert {tuple(r) for r in pairs.collect()} == {("a", True, 300, 300), ("a", False, 600, 600), ("b", True, 600, 600), ("c", False, 600, 600)}


def test_dense_counts_of_different_sets_across_buckets(spark):
    """40,000 token sets of one block: counts and first product where the bits lie in two bitmaps."""
    cat = spark.range(40_000).select(
        F.format_string("P%06d", "id").alias("product_id"), F.concat(F.lit("Azul s"), F.col("id").cast("string")).alias("canonical_name"), F.lit("Casa").alias("producer"),
        F.lit("Tequila").alias("category"), F.when(F.col("id") == 39_999, 700).otherwise(500).cast("int").alias("size_ml"), F.lit(True).alias("vintage_required"))
    index = match.build_index(cat)
    assert index.postings is not None
    sigs = spark.createDataFrame([("casa", "Tequila", size, norm) for size in (500, 700, 900) for norm in ("azul", "s7 azul")], "producer_key string, category string, size_ml int, norm string")
    got = {(r.size_ml, r.norm): (r.n_at_size, r.n_any, r.first_at and r.first_at.product_id) for r in match.candidate_counts(sigs, index).collect()}
    assert got == {(500, "azul"): (39_999, 40_000, "P000000"), (700, "azul"): (1, 40_000, "P039999"), (900, "azul"): (0, 40_000, None),
                   (500, "s7 azul"): (1, 1, "P000007"), (700, "s7 azul"): (0, 1, None), (900, "s7 azul"): (0, 1, None)}


def test_two_dense_tokens_are_looked_up_together(spark):
    """Each token asked for is in 300 of 900 sets or more, two of them together in few: no bitmap is moved."""
    rows = [(f"P{i:04}", f"a{i % 3} b{i // 3 % 3} c{i % 300} s{i}", "Casa", "Rum", (500, 700)[i % 2], False) for i in range(900)]
    rows += [(f"Q{i:04}", f"a{i % 3} z{i % 2} y{i}", "Casa", "Rum", 500, False) for i in range(900)]
    index = match.build_index(catalog(spark, *rows), dense=200)
    norms = ["a0 b0", "b1 a2", "a1 b2 c7", "a1 b2 c8", "a0 b1 z1", "z0 a0", "z1 z0", "a0", "b0 b1"]
    sigs = spark.createDataFrame([("casa", "Rum", size, norm) for size in (500, 700, 900) for norm in norms], "producer_key string, category string, size_ml int, norm string")
    found = match.candidate_counts(sigs, index)
    got = {(r.size_ml, r.norm): (r.n_at_size or 0, r.n_any, r.first_at and tuple(r.first_at)) for r in found.collect() if r.n_any}
    expected = {}
    for r in sigs.collect():
        hits = [p for p in rows if set(r.norm.split()) <= set(p[1].split())]
        at = sorted((p[0], p[5]) for p in hits if p[4] == r.size_ml)
        if hits:
            expected[r.size_ml, r.norm] = (len(at), len(hits), at[0] if at else None)
    assert got == expected and {n for _, n in got} == {"a0 b0", "b1 a2", "a1 b2 c7", "z0 a0", "a0"}
    # of tokens that meet in few sets none is left to the bitmaps
    few = match.candidate_counts(sigs.filter("norm in ('a0 b0', 'b1 a2', 'z0 a0', 'b0 b1')"), index)
    assert "bitmap_and_agg" not in few._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_and_agg" in found._jdf.queryExecution().optimizedPlan().toString()  # the token alone
