"""The corpus pipeline's stages on a small table, and the registered queries on the smallest one."""

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__
from tests.llm.samples import documents, edge_rows, prose


def test_stages_in_order(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "exact_dedup", "near_dedup", "packing"]
    rng = random.Random(5)
    texts = [prose(rng, 80) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(300 + i, " " + texts[i] + "\n") for i in range(20)]  # exact copies
    rows += [(400 + i, texts[50 + i] + " more") for i in range(20)]  # near copies
    rows += [(500 + i, ("spam" + str(i) + " ") * 80) for i in range(60)]  # rejected
    docs = documents(spark, rows + [(900, None), (901, "")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 200 or 300 <= i < 500), 0) for i, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, str(tmp_path))
    ids = {r["doc_id"] for r in good.collect()}
    assert not ids & set(range(500, 560)) and ids >= set(range(200))
    named = stages["language"](spark, good, str(tmp_path))
    assert {r["doc_id"] for r in named.collect()} >= set(range(200))
    exact = stages["exact_dedup"](spark, named, str(tmp_path))
    left = {r["doc_id"] for r in exact.collect()}
    assert not left & set(range(20)) and left >= {*range(20, 200), *range(300, 320), *range(400, 420)}  # the longer original stays
    near = stages["near_dedup"](spark, exact, str(tmp_path))
    last = {r["doc_id"] for r in near.collect()}
    assert not last & set(range(400, 420)) and last >= {*range(20, 200), *range(300, 320)}
    for frame in (good, named, exact, near):
        assert frame.schema.names == docs.schema.names
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == last
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (documents(spark, edge_rows(random.Random(6))), documents(spark, []).limit(0)):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, docs, str(tmp_path))
            assert (out.count() == 0) == (docs.count() == 0)
            if name != "packing":
                assert out.schema.names == docs.schema.names


def test_queries_are_registered():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
