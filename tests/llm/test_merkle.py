"""The Merkle manifest against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.samples import documents, edge_rows
from vinculum.llm import merkle
from vinculum.llm.queries import op11_merkle_manifest


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row: tuple, text: str | None) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def fold(nodes: list[str]) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """Root, and the path (place, run) of every node."""
    paths: list[list[tuple[int, list[str]]]] = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for r, run in enumerate(runs):
            for place in range(len(run)):
                for i in under[3 * r + place]:
                    paths[i].append((place, run))
        under = [sum(under[i : i + 3], []) for i in range(0, len(nodes), 3)]
        nodes = [h("".join(run)) for run in runs]
    return nodes[0], paths


def brute(rows: list[tuple]) -> list[tuple]:
    """Rows (doc_id, source, lang, n_chars, text)."""
    by_source = defaultdict(list)
    for row in rows:
        text = row[4]
        if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        by_source[row[1]].append((row[0], leaf_of(row, row[4]), leaf_of(row, text)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(by_source[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for s in order}
    trees = {s: fold([x[1] for x in leaves[s]]) for s in order}
    if not order:
        return []
    root, upper = fold([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, upper):
        for (doc_id, leaf, edited), path in zip(leaves[s], trees[s][1]):
            path = path + top
            proof, now = "", edited
            for place, run in path:
                proof += "".join(run[:place] + run[place + 1 :])
                now = h("".join([*run[:place], now, *run[place + 1 :]]))
            out.append((doc_id, leaf, trees[s][0], root, h(proof), now, now == root))
    return out


def check(spark, rows: list[tuple], **options) -> None:
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    got = merkle.manifest(docs.withColumn("pos", F.lit(3)).withColumn("digest", F.lit("x")), tampered=tampered, **options)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


def sample(rng: random.Random, n: int, sources: list) -> list[tuple]:
    ids = rng.sample(range(10 * n + 10), n)
    return [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 5]), rng.choice([None, "", "a\nb", "plain", "é\n\n"])) for i in ids]


@pytest.mark.parametrize("n, sources, levels", [(1, ["a"], 2), (2, ["a", None], 1), (90, ["a", "a", "a", "é", None, "b"], 1), (300, ["a", "b", None, "", "s"], 2), (40, [f"s{i}" for i in range(40)], 1)])
def test_trees_of_several_rounds(spark, n, sources, levels):
    check(spark, sample(random.Random(n), n, sources), levels=levels)


def test_repeated_ids_and_equal_rows(spark):
    rows = [(7, "a", "en", 3, "x\ny")] * 40 + [(7, "a", "en", 3, "z\n")] * 9 + [(None, "a", None, None, None)] * 5 + [(8, None, "en", 1, "\n")] * 2
    check(spark, rows, levels=1)


def test_versions_copy_only_ancestors(spark):
    rows = [(i, "a", "en", 1, "x\n") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    tampered = F.when(F.col("doc_id") == 50, F.lit("x")).otherwise(F.col("text"))
    got = merkle.manifest(docs, tampered=tampered, copies=True, levels=2).collect()
    assert [(r["doc_id"], len(r["copied"])) for r in got if r["copied"]] == [(50, 5)]  # 100, 34, 12, 4, 2, 1
    edited = next(r for r in got if r["doc_id"] == 50)
    assert edited["copied"][-1] == edited["folded_root"] != edited["root"] and not edited["verified"]
    assert all(r["verified"] for r in got if r["doc_id"] != 50)


def test_query_on_edge_rows(spark, tmp_path):
    rng = random.Random(11)
    rows = [(*r, "en", "src1")[:4] if len(r) == 2 else r for r in edge_rows(rng)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = [(i, source, lang, len(text or ""), text) for i, text, lang, source in rows]
    got = sorted(map(tuple, op11_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(brute(docs), key=repr)
    documents(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op11_merkle_manifest(spark, f"{tmp_path}/none").count() == 0
