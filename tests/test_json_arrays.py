"""JSON arrays read in splits, against the json module on whole files."""

from __future__ import annotations

import gzip
import json
import random

import pytest

from vinculum.sources import jsonarray, jsonsrc


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size: int) -> None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def _texts(spark, path) -> list[str]:
    rows = jsonarray.read_elements(spark, str(path)).orderBy("file", "block", "row").collect()
    return [r.text for r in rows]


def _value(rng: random.Random, depth: int = 0):
    odd = ["", "}", "{", '"', "\\", '\\"}', "a, b", "[", "]", "\n", "é中😀", "\\u007d", "x" * 40]
    kind = rng.randint(0, 6 if depth < 3 else 3)
    if kind <= 1:
        return "".join(rng.choices(odd, k=rng.randint(0, 4)))
    if kind == 2:
        return rng.choice([1, -2.5, 1e30, None, True])
    if kind == 3:
        return rng.randint(0, 99)
    if kind == 4:
        return [_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(odd): _value(rng, depth + 1) for _ in range(rng.randint(0, 4))}


@pytest.mark.parametrize("size, indent", [(150, None), (700, 2), (5000, 1)])
def test_elements_of_any_kind_in_splits_of_any_size(spark, tmp_path, small_splits, size, indent):
    rng = random.Random(size)
    small_splits(size)
    folder = tmp_path / "in"
    folder.mkdir()
    files = [[_value(rng) for _ in range(rng.choice([0, 1, 60]))] for _ in range(4)]
    for i, items in enumerate(files):
        (folder / f"{i}.json").write_text("\n " * (i % 2) + json.dumps(items, indent=indent, ensure_ascii=bool(i % 2)) + "\n" * (i % 3))
    got = [json.loads(t) for t in _texts(spark, folder)]
    assert got == [x for items in files for x in items]
    assert jsonarray.read_elements(spark, str(folder)).select("file", "block", "row").distinct().count() == len(got)


def test_broken_elements_are_records_of_their_own(spark, tmp_path):
    text = '[{"submission_id":"a"}, {"submission_id":}, 12, "x", null, {"submission_id":"b","q":[1,{"z":"}"}]}, [3], {"submission_id":"c"}]'
    path = tmp_path / "in.json"
    path.write_bytes(b"\xef\xbb\xbf" + text.encode())
    rows = jsonsrc.read_submissions(spark, str(path), multiline=True).orderBy("position").collect()
    assert [r.raw_json for r in rows] == ['{"submission_id":"a"}', '{"submission_id":}', "12", '"x"', "null", '{"submission_id":"b","q":[1,{"z":"}"}]}', "[3]", '{"submission_id":"c"}']
    assert [r.submission_id for r in rows] == ["a", None, None, None, None, "b", None, "c"]
    assert [r.record_invalid for r in rows] == [False, True, True, True, True, False, True, False]


@pytest.mark.parametrize(
    "text, good, bad",
    [
        ('[{"submission_id":"a"},{"submission_id":"b"', ["a"], ['{"submission_id":"b"']),  # cut off
        ('[{"submission_id":"a"},{"submission_id":"b"}', ["a", "b"], []),
        ('[{"submission_id":"a"}] trailing', ["a"], ["trailing"]),
        ('{"submission_id":"a"}', ["a"], []),  # one record, no array
        ('{"submission_id":"a"},{"submission_id":"b"}', [], ['{"submission_id":"a"},{"submission_id":"b"}']),
        ('no json at all', [], ["no json at all"]),
        ('[{"submission_id":"a"},{"submission_id":"b},{"submission_id":"c"}]', ["a"], ['{"submission_id":"b},{"submission_id":"c"}]']),  # a quote is missing
        ("[]", [], []),
        ("", [], []),
        (" \n[ \n]\n", [], []),
    ],
)
def test_files_that_are_no_whole_array(spark, tmp_path, text, good, bad):
    (tmp_path / "in.json").write_text(text)
    rows = jsonsrc.read_submissions(spark, str(tmp_path / "in.json"), multiline=True).orderBy("position").collect()
    assert [r.submission_id for r in rows if not r.record_invalid] == good
    assert [r.raw_json for r in rows if r.record_invalid] == bad


def test_nothing_may_stand_behind_a_record(spark, tmp_path):
    one = '{"submission_id":"a","q":[{"r":"}]"}]}'
    lines = [one, one + " ", one + ",", one + " x", one + "]", one + "],[" + one, one + ',"k":1', one + "}", one + one, one + ",null", "[" + one + "]", "null"]
    (tmp_path / "in.ndjson").write_text("\n".join(lines))
    rows = jsonsrc.read_submissions(spark, str(tmp_path / "in.ndjson")).orderBy("position").collect()
    assert [r.raw_json for r in rows] == lines
    assert [r.raw_json for r in rows if not r.record_invalid] == lines[:2]


def test_a_text_without_end_is_given_in_parts(spark, tmp_path, small_splits, monkeypatch):
    small_splits(400)
    monkeypatch.setattr(jsonarray, "RECORD_BYTES", 1000)
    text = '[{"submission_id":"a"},{"submission_id":"b},' + '{"submission_id":"c"},' * 300 + '{"submission_id":"d"}]'
    (tmp_path / "in.json").write_text(text)
    rows = jsonsrc.read_submissions(spark, str(tmp_path / "in.json"), multiline=True).orderBy("position").collect()
    assert rows[0].submission_id == "a" and all(r.record_invalid for r in rows[1:])
    assert sum(len(r.raw_json) for r in rows) >= len(text) - 400 // 100 * 60 and max(len(r.raw_json) for r in rows) < 2000


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    small_splits(1 << 20)
    n = 60_000
    with open(tmp_path / "in.json", "w") as f:
        f.write("[\n" + ",\n".join(json.dumps({"submission_id": f"S{i}", "name": f"n {{{i}}} \"q\"", "size_ml": 700}) for i in range(n)) + "\n]\n")
    rows = jsonsrc.read_submissions(spark, str(tmp_path / "in.json"), multiline=True)
    assert rows.filter("not record_invalid").select("submission_id").distinct().count() == rows.count() == n
    assert rows.select("position.block").distinct().count() >= 3


def test_compressed_files(spark, tmp_path):
    items = [{"submission_id": f"S{i}", "q": {"r": "}"}} for i in range(50)]
    with gzip.open(tmp_path / "in.json.gz", "wt") as f:
        json.dump(items, f, indent=1)
    assert [json.loads(t) for t in _texts(spark, tmp_path / "in.json.gz")] == items


def test_a_catalog_array_is_read_in_splits_and_aborts_on_a_broken_product(spark, tmp_path):
    path = tmp_path / "catalog.json"
    products = [{"product_id": f"P{i:05}", "canonical_name": f"N {i} }}]", "producer": "House", "category": "Rum", "size_ml": 700} for i in range(5000)]
    products[7]["vintage_required"] = True
    path.write_text(json.dumps(products))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // 5))
    try:
        rows = jsonsrc.read_catalog(spark, str(path)).collect()
        assert sorted(r.product_id for r in rows) == [p["product_id"] for p in products]
        assert [r.product_id for r in rows if r.vintage_required] == ["P00007"]
        assert {r.canonical_name for r in rows} == {p["canonical_name"] for p in products}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    lines = tmp_path / "catalog.ndjson"
    lines.write_text("\n".join([json.dumps(p) for p in products[:3]] + [""]))
    assert jsonsrc.read_catalog(spark, str(lines), multiline=False).count() == 3
    for broken in ('[{"product_id": "P1", "size_ml": "large"}]', json.dumps([{**products[0], "category": "Cider"}]), json.dumps([{"product_id": "P1"}])):
        path.write_text(broken)
        with pytest.raises(Exception, match="MALFORMED_RECORD|catalog domains"):
            jsonsrc.read_catalog(spark, str(path))


def test_the_array_import_query_reads_its_files_once_written(spark, tmp_path):
    """The two lists of the query come from written tables; neither parses the records again."""
    from vinculum.plans.queries import QUERIES

    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate string"
    spark.createDataFrame([(1, "red ring", "Brand#1", "SMALL", 3)], part).write.parquet(f"{tmp_path}/part.parquet")
    rows = [(1, 1, 1, 1, 1.0, 2.0, "2001-01-01"), (1, 1, 2, 1, 1.0, 2.0, "2001-01-01"), (20, 1, 1, 2, 1.0, 2.0, "2002-01-01")]
    lines = spark.createDataFrame(rows, line)
    lines.withColumn("l_shipdate", lines.l_shipdate.cast("timestamp")).write.parquet(f"{tmp_path}/lineitem.parquet")
    df = QUERIES["json_array_import"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "parseJson" not in plan and "MapInArrow" not in plan
    assert sorted((r.submission_id, r.status, r.n) for r in df.collect()) == [("SUB-1-1", "duplicate_id", 1), ("SUB-1-1", "pending", 1), ("SUB-20-2", "invalid", 1)]
