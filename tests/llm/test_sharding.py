from __future__ import annotations

import random
import zlib

import pytest

from tests.llm.samples import documents, edge_rows
from vinculum.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 6, 7, 24, 100, 1023])
def test_permutation_is_complete_and_computable(spark, n):
    got = {r["id"]: r["p"] for r in sharding.shuffled(spark.range(n), "id", n, "p").collect()}
    assert sorted(got.values()) == list(range(n))
    assert all(sharding.locate(i, n, 5) == (p % 5, p // 5) for i, p in got.items())


def test_shards_are_balanced_gapless_and_reproducible(spark):
    rows = edge_rows(random.Random(1)) + [(1000 + i, "t" * (i % 50)) for i in range(300)]
    docs = documents(spark, rows)
    got = sharding.shards(docs.repartition(5)).collect()
    by: dict[int, list[int]] = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(24)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    place = lambda x: sorted(((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in x), key=str)
    assert place(got) == place(sharding.shards(docs.coalesce(1)).collect())
    texts = {i: t or "" for i, t, *_ in rows if i is not None}
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None
        if r["doc_id"] is not None:
            assert r["size"] == len(texts[r["doc_id"]].encode()) + 8
            assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())


def test_empty_and_seed(spark):
    assert sharding.shards(documents(spark, []).limit(0)).count() == 0
    a = {r["p"] for r in sharding.shuffled(spark.range(10), "id", 10, "p", seed=1).limit(3).collect()}
    b = {r["p"] for r in sharding.shuffled(spark.range(10), "id", 10, "p", seed=2).limit(3).collect()}
    assert a != b


def test_main_path_is_native(spark, capsys):
    sharding.shards(documents(spark, [(1, "a"), (2, "b")])).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
