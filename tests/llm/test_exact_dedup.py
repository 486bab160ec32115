from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.samples import documents, edge_rows, prose
from vinculum.llm import exact_dedup


def brute_force(rows: list[tuple]) -> list[tuple]:
    content = [re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows]
    best: dict[str, tuple] = {}
    for r, c in zip(rows, content):
        rank = (-len(r[1] or ""), r[0] is None, r[0] or 0)
        best[c] = min(best.get(c, rank), rank)
    out, done = [], set()
    for r, c in zip(rows, content):
        keep = None if best[c][1] else best[c][2]
        kept = r[0] == keep and len(r[1] or "") == -best[c][0] and c not in done
        done |= {c} if kept else set()
        out.append((r[0], keep, content.count(c), kept, hashlib.sha256(c.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(rng: random.Random) -> list[tuple]:
    rows = edge_rows(rng)
    hot = prose(rng, 30)
    rows += [(100 + i, hot + " " * (i % 3)) for i in range(60)] + [(200 + i, prose(rng, 5)) for i in range(40)]
    return rows


def test_members_equal_brute_force(spark):
    rows = rows_of(random.Random(3))
    got = exact_dedup.members(documents(spark, rows).repartition(4), salts=4)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(rows)


def test_colliding_digests_never_merge_texts(spark):
    rows = rows_of(random.Random(5))
    got = exact_dedup.members(documents(spark, rows).repartition(3), digest=lambda c: F.substring(F.sha2(c, 256), 1, 1)).drop("digest")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((r[:4] for r in brute_force(rows)), key=str)


def test_deduplicate_keeps_one_row_and_all_columns(spark):
    rows = rows_of(random.Random(6))
    docs = documents(spark, rows).repartition(4)
    out = exact_dedup.deduplicate(docs)
    assert out.schema.names == docs.schema.names
    kept = sorted({(r[0], r[4]) for r in brute_force(rows) if r[3]}, key=str)
    got = sorted(((r["doc_id"], hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "").encode()).hexdigest()) for r in out.collect()), key=str)
    assert got == kept
    assert out.filter("_digest = 1 and _id = 'i' and digest = 'd'").count() == len(kept)


def test_empty_table(spark):
    docs = documents(spark, []).limit(0)
    assert exact_dedup.members(docs).count() == 0
    assert exact_dedup.deduplicate(docs).count() == 0


def test_main_path_is_native(spark, capsys):
    exact_dedup.members(documents(spark, [(1, "a")])).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_one_row_of_a_repeated_id_is_kept(spark):
    rows = [(1, "a b"), (1, "a\tb"), (1, "a b"), (2, "ab"), (None, "c"), (None, "c"), (3, "d"), (3, "e")]
    docs = documents(spark, rows).repartition(3)
    got = sorted((r["doc_id"] or 0, r["group_size"], r["kept"]) for r in exact_dedup.members(docs).collect())
    assert got == [(0, 2, False), (0, 2, True), (1, 4, False), (1, 4, False), (1, 4, True), (2, 4, False), (3, 1, True), (3, 1, True)]
    texts = [r["text"] for r in exact_dedup.deduplicate(docs).collect()]
    stays = max(("a b", "a\tb"), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert sorted(texts) == sorted([stays, "c", "d", "e"])
