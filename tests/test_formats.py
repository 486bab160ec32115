"""Scalar helpers and formats: percent (X8), error join (X7), first element (X10), request text
(L1), status order (O2), and partition overwrite of the store (H16)."""

from __future__ import annotations

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import RUN_TS
from vinculum.functions.text import first_or_null, join_errors, percent
from vinculum.operators import ingest, report, resolve
from vinculum import session
from vinculum.plans import pipeline
from vinculum.sources import jsonsrc
from vinculum.sources import store as ST
from vinculum.sources.store import stage_table


def test_percent_matches_python_formatting(spark):
    cases = [(32, 32), (0, 5), (1, 3), (49, 400), (1, 8), (3, 0)]
    df = spark.createDataFrame(cases, "n long, d long").select("n", "d", percent(F.col("n"), F.col("d")).alias("p"))
    got = {(r.n, r.d): r.p for r in df.collect()}
    for n, d in cases:
        want = f"{n / d * 100:.1f}%" if d else "-"
        assert got[(n, d)] == want, (n, d)


def test_join_errors_and_first_element(spark):
    df = spark.createDataFrame([("a", None, "c", ["x", "y"]), (None, None, None, [])],
                               "e1 string, e2 string, e3 string, arr array<string>")
    rows = df.select(join_errors(F.col("e1"), F.col("e2"), F.col("e3")).alias("j"),
                     first_or_null(F.col("arr")).alias("f")).collect()
    assert (rows[0].j, rows[0].f) == ("a; c", "x")
    assert (rows[1].j, rows[1].f) == (None, None)


def test_request_text_formats(spark):
    cat = spark.createDataFrame([("P1", "Name", "Prod", "Wine", 750, True), ("P2", "Other", "Prod", "Rum", 50, False)],
                                "product_id string, canonical_name string, producer string, category string, "
                                "size_ml int, vintage_required boolean")
    lines = {r.product_id: r.line for r in resolve.block_context(cat).collect()}
    assert lines == {"P1": "P1: Prod / Name (Wine, 750 ml, needs vintage)", "P2": "P2: Prod / Other (Rum, 50 ml)"}
    msg = spark.createDataFrame([("S1", "N", "P", "Rum", None, 700)],
                                "i string, n string, p string, c string, v int, s int").select(
        resolve.user_message(*[F.col(c) for c in ("i", "n", "p", "c", "v", "s")]).alias("m")).first().m
    assert msg == "Which product is this? id=S1; name=N; producer=P; category=Rum; vintage=-; ml=700"
    al = spark.createDataFrame([("k and b", "Kell and Byrne"), ("casa norte", "Casa del Norte")], "alias string, canonical string")
    text = {(r.block_producer, r.line) for r in resolve.system_lines(al).collect()}
    assert text == {(None, resolve.SYSTEM_HEAD), ("kell and byrne", "Kell and Byrne is also called k and b"),
                    ("casa del norte", "Casa del Norte is also called casa norte")}


def test_catalog_load_is_all_or_nothing(spark, tmp_path):
    schema = "product_id string, canonical_name string, producer string, category string, size_ml int, vintage_required boolean"
    path = str(tmp_path / "catalog")

    def batch(*rows):
        return spark.createDataFrame([(*r, False) for r in rows], schema)

    first = batch(("P1", "A", "Prod", "Rum", 700), ("P2", "A", "Prod", "Rum", 1000))
    ST.load_catalog(first, path)
    for bad, rule in (
        (first, "repeated product_id"),
        (batch(("P9", "A", "Prod", "Rum", 700)), "repeated (canonical_name, producer, size_ml)"),
        (batch(("P9", "B", "Prod", "Cider", 700)), "rows outside the domains"),
    ):
        with pytest.raises(ST.CatalogRejected) as e:
            ST.load_catalog(bad, path)
        assert rule in e.value.violations
        assert spark.read.parquet(path).count() == 2
    ST.load_catalog(batch(("P3", "B", "Prod", "Rum", 700)), path)
    assert spark.read.parquet(path).count() == 3
    ST.load_catalog(first, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 2


def test_stored_ids_are_looked_up_in_the_index(spark, tmp_path):
    path = str(tmp_path / "ids")
    for name, ids in (("a", range(0, 50)), ("b", range(50, 60))):
        ST.write_ids(spark.createDataFrame([(f"S{i}",) for i in ids], "submission_id string"), path, name)
    asked = spark.createDataFrame([("S1",), ("S1",), ("S55",), ("S99",), (None,)], "submission_id string")
    assert sorted(r.submission_id for r in ST.stored_among(asked, path, "c").collect()) == ["S1", "S55"]
    assert [r.submission_id for r in ST.stored_among(asked, path, "b").collect()] == ["S1"]  # a re-run doesn't see itself


def _above(df, words):
    """The operators of the planned query from the one whose line has ``words`` up to the root."""
    lines = df.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if words in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    out, inner = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < inner:
            inner = depth(line)
            out.append(line)
    return out


def test_look_ups_leave_the_stored_side_in_its_buckets(spark, tmp_path, capsys):
    store = str(tmp_path / "it's a store")
    for name in ("a", "b", "c"):
        rows = _answered(spark, name, [(f"{name}{i}", f"f{name}{i}", f"out {name}{i}", RUN_TS) for i in range(300)])
        cache = ST.read_answers(spark, store, ST.answers_path(store))
        ST.write_ids(rows, ST.ids_path(store), name)
        ST.write_answers(resolve.new_cache_entries(rows, cache), ST.answers_path(store), name)
        if name != "c":  # c is not committed
            ST.commit_import(spark, store, name, RUN_TS)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")  # the number of buckets stays that of the first import
    assert ST.IDS.buckets(spark, ST.ids_path(store)) == int(partitions) != 5
    assert spark.catalog.listTables() == []  # no table outlives its resolution
    asked = spark.range(400).select(F.explode(F.array(*[F.concat(F.lit(n), F.col("id").cast("string")) for n in "abc"])).alias("submission_id"))
    answers = ST.read_answers(spark, store, ST.answers_path(store))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = ST.stored_among(asked, ST.ids_path(store), "b", store)
        assert sorted(r.submission_id for r in known.collect()) == sorted(f"a{i}" for i in range(300))
        wanted = asked.select(F.concat(F.lit("f"), "submission_id").alias("fingerprint"))
        hits = wanted.join(resolve.cache_lookup(answers, "m", "v"), "fingerprint", "left")
        assert hits.filter("cached_output = concat('out ', substr(fingerprint, 2))").count() == 600
        again = resolve.new_cache_entries(_answered(spark, "d", [("x", "fa1", "later", RUN_TS), ("y", "fd1", "new", RUN_TS)]), answers)
        assert [r.fingerprint for r in again.collect()] == ["fd1"]
        other = _answered(spark, "d", [("x", "fa1", "another model's", RUN_TS)]).withColumn("llm_model", F.lit("m2"))
        assert resolve.new_cache_entries(other, answers).count() == 1
        for found in (known, hits, again):
            above = _above(found, "Bucketed: true")
            assert any("SortMergeJoin" in node for node in above) and not any("Exchange" in node for node in above), above
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_printed_lists_are_complete(spark, tmp_path, capsys):
    rows = spark.createDataFrame([("s", "m", 1234567)], "section string, metric string, value long")
    long = spark.range(3000)
    pipeline.print_report(rows, {"all_of_them": long}, str(tmp_path))
    out = capsys.readouterr().out
    assert "[s] m 1,234,567" in out and "3,000 rows" in out
    assert spark.read.parquet(f"{tmp_path}/all_of_them").count() == 3000


def test_scratch_tables_go_with_the_run(spark):
    path = stage_table(spark.range(5), "gone").inputFiles()[0]
    assert os.path.exists(path.removeprefix("file://"))
    session.drop_scratch(spark)
    assert not os.path.exists(path.removeprefix("file://"))
    assert stage_table(spark.range(5), "again").count() == 5


def test_status_counts_in_declaration_order(spark):
    st = spark.createDataFrame([(s, "i") for s in ["unmatched", "invalid", "matched", "matched", "pending"]],
                               "status string, import_id string")
    rows = report.status_counts(st).collect()
    assert [(r.status, r.n) for r in rows] == [("pending", 1), ("invalid", 1), ("matched", 2), ("unmatched", 1)]


def test_partition_overwrite_keeps_other_imports(spark, tmp_path):
    path = str(tmp_path / "store")
    a = spark.createDataFrame([("S1", "imp-a", "matched"), ("S2", "imp-b", "review")],
                              "submission_id string, import_id string, status string")
    ST.write_import(a, path)
    ST.write_import(spark.createDataFrame([("S3", "imp-b", "no_match")],
                                          "submission_id string, import_id string, status string"), path)
    rows = sorted((r.submission_id, r.import_id) for r in ST.read_store(spark, path).collect())
    assert rows == [("S1", "imp-a"), ("S3", "imp-b")]
    assert ST.read_import(spark, path, "imp-a").count() == 1
    assert ST.revert_import(ST.read_store(spark, path), "imp-a").count() == 1


def _answered(spark, import_id, rows):
    schema = ("submission_id string, import_id string, status string, fingerprint string, llm_model string, "
              "llm_prompt_version string, llm_output string, updated_at timestamp")
    return spark.createDataFrame([(sid, import_id, "matched", fp, "m", "v", out, ts) for sid, fp, out, ts in rows], schema)


def test_a_crash_between_the_writes_leaves_no_trace(spark, tmp_path, monkeypatch):
    from tests.test_matching import OTHER_NAMES, catalog

    cat = catalog(spark, ("A1", "Uno"))
    names = spark.createDataFrame(OTHER_NAMES, "alias string, canonical string")
    store = str(tmp_path / "store")
    records = spark.createDataFrame([(f"S{i}", "Uno", "Casa del Norte", "Tequila", None, 700, i) for i in range(3)],
                                    "submission_id string, name string, producer string, category string, vintage int, size_ml int, position long")

    def run(import_id):
        return pipeline.run_import(spark, records, cat, names, import_id=import_id, run_ts=RUN_TS, store_path=store)

    for broken in ("write_ids", "commit_import"):
        with monkeypatch.context() as m:
            m.setattr(ST, broken, lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                run("imp-1")
        assert ST.read_store(spark, store).count() == 0
    assert run("imp-2").final.count() == 3  # nothing counts as stored already
    assert {r.import_id for r in ST.read_store(spark, store).select("import_id").collect()} == {"imp-2"}
    assert run("imp-1").final.count() == 0  # the crashed import, repeated: its ids are another's now
    assert run("imp-2").final.count() == 3 and ST.read_store(spark, store).count() == 3


def test_a_revert_takes_ids_and_answers_along(spark, tmp_path):
    store = str(tmp_path / "store")
    first = _answered(spark, "a", [("S1", "f1", "old", dt.datetime(2026, 1, 1)), ("S2", "f2", "only here", dt.datetime(2026, 1, 1))])
    second = _answered(spark, "b", [("S3", "f1", "old", dt.datetime(2026, 1, 2)), ("S4", "f3", "own", dt.datetime(2026, 1, 2))])
    cache = None
    for name, rows in (("a", first), ("b", second)):
        ST.begin_import(spark, store, name)
        ST.write_import(rows, store)
        ST.write_ids(rows, ST.ids_path(store), name)
        cache = ST.read_answers(spark, store, ST.answers_path(store))
        ST.write_answers(resolve.new_cache_entries(rows, cache), ST.answers_path(store), name)
        ST.commit_import(spark, store, name, RUN_TS)

    def left():
        answers = ST.read_answers(spark, store, ST.answers_path(store))
        return (sorted((r.import_id, r.fingerprint, r.llm_output) for r in answers.collect()), sorted(r.submission_id for r in ST.read_store(spark, store).collect()))

    assert left() == ([("a", "f1", "old"), ("a", "f2", "only here"), ("b", "f3", "own")], ["S1", "S2", "S3", "S4"])
    asked = spark.createDataFrame([("S1",), ("S3",)], "submission_id string")
    for _ in range(2):  # repeating a revert changes nothing
        ST.drop_import(spark, store, "a")
        assert left() == ([("b", "f1", "old"), ("b", "f3", "own")], ["S3", "S4"])
        assert [r.submission_id for r in ST.stored_among(asked, ST.ids_path(store), "c", store).collect()] == ["S3"]


def test_a_catalog_append_moves_no_stored_row_and_look_ups_prune(spark, tmp_path, capsys):
    from vinculum.operators.match import catalog_find

    path = str(tmp_path / "catalog")
    schema = "product_id string, canonical_name string, producer string, category string, size_ml int, vintage_required boolean"
    rows = [(f"P{i:04}", f"N{i}", f"House {i % 50:02}", ["Rum", "Wine"][i % 2], 700, False) for i in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ST.load_catalog(spark.createDataFrame(rows, schema), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = ST.read_catalog(spark, path)
    batch = spark.createDataFrame([("P0007", "X", "House 01", "Rum", 700, False)], schema)
    for keys in (["product_id"], ["canonical_name", "producer", "size_ml"]):
        plan = ST.already_stored(stored, batch, keys, 1)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert "Exchange" not in plan[: plan.index("BroadcastExchange")].replace("BroadcastExchange", "")  # none over the catalog
    found = catalog_find(stored, producer="HOUSE 07", category="Wine")
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(producer_key,house 07)" in plan and "EqualTo(category,Wine)" in plan
    assert found.count() == 40 and found.columns[0] == "product_id"
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    here = stored.filter("producer_key = 'house 07'").select(F.input_file_name().alias("f")).distinct().count()
    assert len(files) > 3 and here <= 2


def test_confidence_drift(spark):
    import random

    rng = random.Random(2)
    early = [("a", dt.datetime(2026, 1, 1), rng.random()) for _ in range(4000)]
    same = [("b", dt.datetime(2026, 1, 2), rng.random()) for _ in range(4000)]
    moved = [("c", dt.datetime(2026, 1, 3), 0.8 + rng.random() / 5) for _ in range(4000)]
    none = [("d", dt.datetime(2026, 1, 4), None)]
    store = spark.createDataFrame(early + same + moved + none, "import_id string, created_at timestamp, llm_confidence double").repartition(5)
    bins = report.confidence_bins(store).groupBy("import_id").agg(F.count("*").alias("bins"), F.sum("n").alias("n")).collect()
    assert sorted(map(tuple, bins)) == [("a", 20, 4000), ("b", 20, 4000), ("c", 20, 4000)]
    psi = {r.import_id: r.psi for r in report.confidence_shift(store).collect()}
    assert psi["a"] is None and psi["b"] < 0.05 and psi["c"] > 1
    sketches = report.confidence_sketches(store)
    for ids in (["a"], ["a", "b", "c"]):
        values = sorted(v for name, _, v in early + same + moved if name in ids)
        got = report.confidence_quantiles(sketches.filter(F.col("import_id").isin(ids)), [0.05, 0.5, 0.95]).collect()
        for r in got:
            exact = sum(v <= r.confidence for v in values) / len(values)
            assert abs(exact - r["rank"]) < 0.02, (ids, r, exact)


def test_a_filter_on_a_record_parses_it_no_oftener(spark, tmp_path):
    """The import keeps records with an id: the filter must not move below the parse with copies of it."""
    (tmp_path / "in.json").write_text('{"submission_id":"a","name":"Uno"}\n{"submission_id":7}\nnothing\n')
    raw = jsonsrc.read_submissions(spark, str(tmp_path / "in.json"))
    imported = ingest.import_records(raw, "i", RUN_TS, variant=True)
    for df, parses in ((imported.state, 4), (imported.records, 3)):  # 34 where the filter moves
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert 0 < plan.lower().replace("_", "").count("parsejson(") <= parses, plan
    assert [r.submission_id for r in imported.state.collect()] == ["a"]
    assert sorted(r.skip or "" for r in imported.records.collect()) == ["", "invalid_id", "invalid_record"]


def test_marked_duplicates_are_a_stage_table(spark, tmp_path):
    """Tier 1's two jobs start from the marked rows instead of joining all rows to their groups again."""
    from vinculum.plans.scenario import Scenario

    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate string"
    spark.createDataFrame([(1, "red ring", "Brand#1", "SMALL", 3)], part).write.parquet(f"{tmp_path}/part.parquet")
    lines = spark.createDataFrame([(20, 1, 1, 1, 1.0, 2.0, "2001-01-01"), (40, 1, 1, 1, 1.0, 2.0, "2001-01-01")], line)
    lines.withColumn("l_shipdate", lines.l_shipdate.cast("timestamp")).write.parquet(f"{tmp_path}/lineitem.parquet")
    deduped = Scenario(spark, str(tmp_path)).deduped
    assert "Join" not in deduped._jdf.queryExecution().optimizedPlan().toString()
    assert all(f.endswith(".zstd.parquet") for f in deduped.inputFiles())
    assert sorted((r.submission_id, r.status, r.duplicate_of) for r in deduped.collect()) == [("SUB-20-1", "pending", None), ("SUB-40-1", "exact_duplicate", "SUB-20-1")]


def test_stage_tables_of_an_import_hold_no_fingerprints(spark, tmp_path):
    """They follow from the fields, and every state has them: null for an invalid row, else the fields' digest."""
    from vinculum.plans.scenario import Scenario

    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"
    parts = [(1, "red ring", "Brand#1", "SMALL", 3), (2, "blue bolt", "Brand#2", "LARGE", 5)]
    spark.createDataFrame(parts, part).write.parquet(f"{tmp_path}/part.parquet")
    lines = [(order, 1 + order % 2, 1, line_no, 1.0, 2.0, dt.datetime(2001, 1, 1)) for order in range(1, 21) for line_no in (1, 2)]
    spark.createDataFrame(lines, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    sc = Scenario(spark, str(tmp_path))
    states = {name: getattr(sc, name) for name in ("deduped", "pending", "tier1", "tier2", "final", "history")}
    for name, state in {"imported": sc.imported.state, **states}.items():
        assert "fingerprint" in state.columns, name
        for path in state.inputFiles():
            assert "fingerprint" not in spark.read.parquet(path).columns, name
    rows = {r.submission_id: r for r in sc.final.collect()}
    assert {r.status for r in rows.values()} >= {"invalid", "matched", "exact_duplicate"}
    for r in rows.values():
        fields = "|".join(["" if x is None else str(x) for x in (r.name, r.producer, r.category, r.vintage, r.size_ml)])
        assert r.fingerprint == (None if r.status == "invalid" else hashlib.sha256(fields.encode()).hexdigest())
    assert sc.final.columns == sc.work.columns
