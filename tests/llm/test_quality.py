from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.samples import documents, edge_rows, prose
from vinculum.llm import quality

LABELS = "doc_id long, quality int, toxic int, text string"


def labelled(rng: random.Random, n: int):
    docs, labels = [], []
    for i in range(n):
        text = prose(rng, 60)
        good = rng.random() < 0.7
        docs.append((i, text if good else rng.choice([text.replace(" ", " | "), (text[:5] + " ") * 50, text.upper().replace(" ", "!! ")])))
        labels.append((i, int(good), 0, "x"))
    return docs, labels


def test_held_out_accuracy_and_hidden_labels(spark):
    rows, labels = labelled(random.Random(1), 600)
    docs, frame = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    model = quality.learn(docs, frame)
    out = quality.with_score(docs, model, "s").select("doc_id", "s", quality.predicted(model, F.col("s")).alias("p"), quality.held_out(F.col("doc_id")).alias("h")).collect()
    truth = {i: q for i, q, *_ in labels}
    held = [r for r in out if r["h"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["p"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["s"] <= 1 and r["p"] == int(r["s"] >= 0.3) for r in out)
    # labels of held-out rows, and other columns, change nothing
    flipped = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 1, "y") for i, q, *_ in labels], LABELS)
    again = quality.learn(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")), flipped)
    assert again == model


def test_every_row_is_scored(spark):
    rows, labels = labelled(random.Random(2), 300)
    model = quality.learn(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    odd = documents(spark, edge_rows(random.Random(3)))
    out = quality.with_score(odd, model, "s")
    assert out.schema.names == [*odd.schema.names, "s"] and out.filter("s is null or s < 0 or s > 1").count() == 0
    assert out.count() == odd.count()
    kept = quality.keep_good(odd, model)
    assert kept.schema == odd.schema
    assert sorted(kept.collect(), key=str) == sorted(out.filter(F.col("s") >= 0.3).drop("s").collect(), key=str)
    assert quality.with_score(odd.limit(0), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0, "")] * 3, [(None, None, None, None), (1, None, 0, ""), (1, 7, 0, "")], [(1, 1, 0, ""), (2, 0, 0, "")]])
def test_too_few_labels_give_the_base_rate(spark, labels):
    docs = documents(spark, [(1, "a b c"), (2, None), (3, "d")])
    model = quality.learn(docs, spark.createDataFrame(labels, LABELS))
    out = quality.with_score(docs, model).collect()
    assert len(out) == 3 and all(r["score"] == pytest.approx(model.base_rate) for r in out)


def test_a_repeated_doc_id_counts_once(spark):
    rows, labels = labelled(random.Random(4), 300)
    frame = spark.createDataFrame(labels, LABELS)
    model = quality.learn(documents(spark, rows), frame)
    hot = next(i for i, _ in rows if zlib.crc32(str(i).encode()) % 5)
    copies = [(hot, dict(rows)[hot] + f" {n}") for n in range(150)]
    assert quality.learn(documents(spark, rows + copies).repartition(4), frame) == model


def test_sizes_cover_whole_texts():
    model = quality.Model(quality.Params(), b"a b c d " * 100, b"x y z " * 100)
    text = b"q" * 9000
    assert quality.Sizes(model).features(text) != quality.Sizes(model).features(text + bytes(range(32, 127)) * 30)
    assert quality.Sizes(model).features(b"") == quality.Sizes(model).features(b"")
