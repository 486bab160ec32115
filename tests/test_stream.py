"""Deliveries into one folder, each imported by an availableNow run of one query."""

from __future__ import annotations

import datetime as dt
import json

from vinculum.operators import report, resolve
from vinculum.plans.pipeline import run_import
from vinculum.sources import jsonsrc
from vinculum.sources import store as ST
from vinculum.streaming.status import start_status_counts
from vinculum.streaming.stream_import import start_stream_import


def _deliver(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))


def test_deliveries_run_every_stage(spark, tmp_path):
    cat = spark.createDataFrame([("P1", "Alpha Beta", "Prod", "Rum", 700, False)],
                                "product_id string, canonical_name string, producer string, category string, "
                                "size_ml int, vintage_required boolean")
    al = spark.createDataFrame([], "alias string, canonical string")
    src, store, ckpt = tmp_path / "src", str(tmp_path / "store"), str(tmp_path / "ckpt")
    rec = {"name": "Alpha Beta", "producer": "Prod", "category": "Rum", "vintage": 2001, "size_ml": 700}
    times = iter([dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 2), dt.datetime(2026, 3, 3)])
    asked = spark.sparkContext.accumulator(0)

    def model(record):
        asked.add(1)
        return json.dumps({"decision": "possible_match", "confidence": 0.9, "candidate_product_ids": ["P1"], "reason": "x"})

    def run():
        start_stream_import(spark, str(src), store, ckpt, cat, al, resolver=resolve.function_resolver(model),
                            clock=lambda: next(times)).awaitTermination()

    _deliver(src, "d1.json", [dict(rec, submission_id="A"), dict(rec, submission_id="B", size_ml=800), dict(rec, submission_id="C"),
                              dict(rec, submission_id="D", name="ALPHA beta"), dict(rec, submission_id="E", name="Gamma"), '{"submission_id": "F'])
    run()
    _deliver(src, "d2.json", [dict(rec, submission_id="A", name="Other"), dict(rec, submission_id="G", vintage=2002),
                              dict(rec, submission_id="H", name="Gamma")])
    run()
    rows = {(r.import_id, r.submission_id): (r.status, r.duplicate_of, r.llm_source, r.created_at)
            for r in ST.read_store(spark, store).collect()}
    t1, t2 = dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 2)
    assert rows == {
        ("stream-000000", "A"): ("matched", None, None, t1),
        ("stream-000000", "B"): ("invalid", None, None, t1),
        ("stream-000000", "C"): ("exact_duplicate", "A", None, t1),
        ("stream-000000", "D"): ("near_duplicate", "A", None, t1),
        ("stream-000000", "E"): ("near_duplicate", "A", "model", t1),
        ("stream-000001", "G"): ("matched", None, None, t2),  # A was stored by the first delivery: skipped
        ("stream-000001", "H"): ("near_duplicate", "G", "cache", t2),  # answered by the first delivery
    }
    assert asked.value == 1

    def kept_counts():
        start_status_counts(spark, store, str(tmp_path / "status")).awaitTermination()
        return sorted(map(tuple, ST.read_status_counts(spark, store).collect()))

    def a1():
        return sorted((i, r.status, r.n) for i in ("stream-000000", "stream-000001")
                      for r in report.status_counts(ST.read_store(spark, store), i).collect())

    assert kept_counts() == a1() == [
        ("stream-000000", "exact_duplicate", 1), ("stream-000000", "invalid", 1), ("stream-000000", "matched", 1),
        ("stream-000000", "near_duplicate", 2), ("stream-000001", "matched", 1), ("stream-000001", "near_duplicate", 1)]
    # the second import replayed, now with one record of another status: its counts replace the old
    # ones in the state that the restarted query finds in its checkpoint
    (tmp_path / "again").mkdir()
    _deliver(tmp_path / "again", "d2.json", [dict(rec, submission_id="G", size_ml=800)])
    again = run_import(spark, jsonsrc.read_submissions(spark, str(tmp_path / "again")), cat, al, import_id="stream-000001",
                       run_ts=dt.datetime(2026, 3, 2), store_path=store, variant=True)
    assert {r.metric: r.value for r in again.report().filter("section = 'input'").collect()} == {
        "records read": 1, "without a usable id": 0, "repeated ids": 0, "kept": 1}
    assert again.imported.counters == {"total": 1, "skipped_invalid_record": 0, "skipped_missing_id": 0, "skipped_invalid_id": 0, "with_id": 1, "inserted": 1}
    assert kept_counts() == a1() == [
        ("stream-000000", "exact_duplicate", 1), ("stream-000000", "invalid", 1), ("stream-000000", "matched", 1),
        ("stream-000000", "near_duplicate", 2), ("stream-000001", "invalid", 1)]
    assert kept_counts() == a1()  # nothing new
    ST.drop_import(spark, store, "stream-000001")
    assert {r.import_id for r in ST.read_status_counts(spark, store).collect()} == {"stream-000000"}
    run_import(spark, jsonsrc.read_submissions(spark, str(tmp_path / "again")), cat, al, import_id="stream-000001",
               run_ts=dt.datetime(2026, 3, 2), store_path=store, variant=True)
    # a run with no new files adds no import
    run()
    assert ST.read_store(spark, store).select("import_id").distinct().count() == 2
