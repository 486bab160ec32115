"""What lets an import grow: compiled checks, JSON pieces taken together, input dealt out without
sampling, no broadcast of a side that grows, and partitions written as the rows come."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import RUN_TS
from vinculum.operators import dedup, ingest, resolve
from vinculum.sources import jsonarray, jsonsrc
from vinculum.sources import store as ST


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_checks_of_json_records_can_be_compiled(spark, tmp_path):
    """The JVM compiles no method of 8000 bytes or more."""
    text = '{"submission_id":"a","name":"N","producer":"P","category":"Rum","vintage":2001,"size_ml":700}'
    spark.createDataFrame([(text,)], "value string").write.text(str(tmp_path / "in"))
    rows = jsonsrc.read_submissions(spark, str(tmp_path / "in"))
    debug = spark._jvm.org.apache.spark.sql.execution
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        whole = ingest.import_records(rows, "i", RUN_TS, variant=True).state.drop("fingerprint")
        stages = getattr(getattr(debug.debug, "package$"), "MODULE$").codegenStringSeq(whole._jdf.queryExecution().executedPlan())
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert max(sizes) < 8000, sizes


def test_changes_of_pieces_are_those_of_each_piece():
    rng = random.Random(5)
    for _ in range(300):
        pieces = ["".join(rng.choice('{}[]",:\\ab é\n') for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 8))]
        for inside in (False, True):
            depth, at, found = 0, inside, jsonarray.changes(pa.array(pieces))
            for p in pieces:
                depth += jsonarray.depth_change(p, at)
                at ^= jsonarray.quotes(p) % 2 == 1
                depth -= not at
            assert found[1 + inside] == depth, (pieces, inside)
        assert found[0] == sum(map(jsonarray.quotes, pieces))


def _split(pieces: list[str]) -> pa.RecordBatch:
    n = len(pieces)
    columns = {"file": ["f"] * n, "block": [0] * n, "value": pieces, "in_string": [False] * n, "depth": [0] * n, "is_array": [True] * n, "pieces": [n] * n, "is_last": [True] * n, "open_end": [True] * n}
    return pa.RecordBatch.from_pydict(columns)


def test_plain_objects_are_taken_together_and_others_one_by_one(monkeypatch):
    calls, one = [], jsonarray.Elements.piece
    monkeypatch.setattr(jsonarray.Elements, "piece", lambda self, text, *a, **k: calls.append(text) or one(self, text, *a, **k))
    texts = ['{"a":%d,"b":"x, y \\" z"}' % i for i in range(500)]
    texts[200] = '{"a":{"c":"}"},"d":[1,2]}'
    texts[300] = "17"
    pieces = ("[" + ",\n ".join(texts) + "\n]").split("}")
    found = pa.Table.from_batches(jsonarray._found(iter([_split(pieces)]))).to_pylist()
    found.sort(key=lambda r: r["row"])
    assert [r["text"] for r in found] == texts and not any(r["carried"] or r["goes_on"] for r in found)
    assert [r["row"] for r in found] == list(range(500))
    assert len(calls) < 12


def _records(spark):
    rows = [("a", "second", 2), ("a", "first", 1), ("b", "only", 3), (None, "no id", 4), ("", "no id", 5)]
    df = spark.createDataFrame(rows, "submission_id string, name string, at int")
    fields = [F.lit(x).cast(t).alias(c) for c, x, t in (("producer", "P", "string"), ("category", "Rum", "string"), ("vintage", 2001, "int"), ("size_ml", 700, "int"))]
    return df.select("submission_id", "name", *fields, F.struct("at").alias("position"))


def test_input_files_keep_the_order_of_an_id_without_a_sampling_pass(spark):
    raw = _records(spark)
    assert "rangepartitioning" not in _plan(jsonsrc._ordered(raw, 3)).lower()
    for path, multiline in ((jsonsrc.write_json_arrays(raw, spark, "t-arrays"), True), (jsonsrc.write_json_lines(raw, spark, "t-lines", ordered=True), False)):
        imp = ingest.import_records(jsonsrc.read_submissions(spark, path, multiline=multiline), "i", RUN_TS, variant=True)
        assert sorted((r.submission_id, r.name) for r in imp.state.collect()) == [("a", "first"), ("b", "only")]
        assert sorted((r.submission_id or "", r.reason, r.n) for r in imp.skipped().collect()) == [("", "missing_id", 1), ("", "missing_id", 1), ("a", "duplicate_id", 1)]


def test_no_side_that_grows_with_an_import_or_the_store_is_broadcast(spark, tmp_path):
    """However small its files are."""
    store = str(tmp_path / "store")
    imp = ingest.import_records(_records(spark), "i", RUN_TS).written(ST.stage_table)
    ST.write_ids(imp.state, ST.ids_path(store), "i")
    answered = imp.state.withColumns({"llm_output": F.lit("{}"), "llm_model": F.lit("m"), "llm_prompt_version": F.lit("1")})
    ST.write_answers(resolve.new_cache_entries(answered, None), ST.answers_path(store), "i")
    cache = ST.read_answers(spark, None, ST.answers_path(store))
    decisions = ST.stage_table(answered.select("fingerprint", "llm_output", F.lit(None).cast("string").alias("llm_error")), "t-decisions")
    stored = ST.stored_among(imp.records, ST.ids_path(store), "j")
    parts = {
        "skipped": imp.skipped(),
        "stored ids": stored,
        "new records": ingest.import_records(_records(spark), "j", RUN_TS, stored_ids=stored).state,
        "new answers": resolve.new_cache_entries(answered, cache),
        "decisions": resolve.table_resolver(decisions)(imp.state.drop("llm_output")),
        "survivors": dedup.with_survivors(imp.state, imp.state),
        "near duplicates": dedup.mark_near_duplicates(imp.state),
        "exact duplicates": dedup.mark_exact_duplicates(imp.state),
    }
    for name, df in parts.items():
        assert "Broadcast" not in _plan(df), name


def test_an_import_is_written_to_its_own_partition_as_its_rows_come(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = lambda *r: spark.createDataFrame(list(r), "submission_id string, import_id string, status string")
    ST.write_import(rows(("1", "a", "pending"), ("2", "b", "pending")), path)
    ST.write_import(rows(("3", "x", "matched"), ("4", "y", "matched")), path, "a")
    ST.write_import(rows(("5", "x", "matched")), path, "c/d=1")
    found = sorted((r.submission_id, r.import_id, r.status) for r in ST.read_store(spark, path).collect())
    assert found == [("2", "b", "pending"), ("3", "a", "matched"), ("4", "a", "matched"), ("5", "c/d=1", "matched")]
