from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from vinculum.llm import neighbours
from vinculum.llm.neighbours import Params

SCHEMA = "vec_id long, embedding array<float>, label int, width int, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 9, 9) for i, v in rows], SCHEMA)


def exact(rows, k, every):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in ok:
        if q % every:
            continue
        best: dict[int, float] = {}
        for i, y in ok:
            if i != q and len(y) == len(x):
                best[i] = max(best.get(i, -2.0), float(neighbours.cosines(neighbours.scaled(y[None]), neighbours.scaled(x))[0]))
        for i, s in best.items():
            out.setdefault(q, {})[i] = max(out.get(q, {}).get(i, -2.0), s)
    return {q: sorted(((-s, i) for i, s in v.items()))[:k] for q, v in out.items()}


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(3000, 64)).astype(np.float32))]
    got = neighbours.nearest(frame(spark, rows).repartition(4), F.col("vec_id") % 50 == 0, Params(block_rows=100)).collect()
    truth = exact(rows, 5, 50)
    scores = {q: {i: -s for s, i in v} for q, v in truth.items()}
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == set(truth)
    hits = 0
    for q, found in by.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        for _, i, s in found:
            assert s == scores[q].get(i, s)
            hits += i in scores[q]
    assert hits / (5 * len(truth)) >= 0.9


def test_edge_vectors_ties_and_hot_vector(spark):
    """A third of the rows are one vector; every probe list is searched, so small sets are exact."""
    unit = [1.0, 2.0, 3.0]
    rows = [(i, unit) for i in range(1, 60)]
    rows += [(100 + i, [float(i), 1.0, -2.0]) for i in range(60)]
    rows += [(1000, None), (1050, []), (1100, [0.0, 0.0, 0.0]), (1150, [1.0, None, 2.0]), (1200, [float("nan"), 1.0, 1.0]), (1250, [float("inf"), 1.0, 1.0]), (None, unit)]
    rows += [(1300, [1.0, 1.0]), (1350, [2.0, 1.0]), (50, [2.0, 4.0, 6.5]), (1400, [1e-30, 1e-30, 1e-30]), (1450, [3e38, 3e38, 3e38])]
    p = Params(probes=99, tables=2, block_rows=8)
    got = neighbours.nearest(frame(spark, rows).repartition(3), F.col("vec_id") % 50 == 0, p).collect()
    by: dict[int, list] = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert by == exact(rows, 5, 50)
    assert [i for _, i in by[1300]] == [1350]


def test_a_repeated_id_takes_one_place(spark):
    """One vec_id in 200 equal and 60 different rows, all nearer than the others of their block."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=16)
    near = lambda noise: [float(x) for x in (base + rng.normal(size=16) * noise).astype(np.float32)]
    rows = [(50, near(0.0))] + [(7, near(0.0))] * 200 + [(7, near(1e-4)) for _ in range(60)] + [(100 + i, near(0.1)) for i in range(30) if (100 + i) % 50]
    p = Params(tables=1, probes=1)
    got = neighbours.nearest(frame(spark, rows).repartition(3), F.col("vec_id") % 50 == 0, p).collect()
    found = [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])]
    assert found == exact(rows, 5, 50)[50] and found[0][1] == 7


def test_the_cut_of_a_block_counts_ids():
    rng = np.random.default_rng(7)
    query = rng.normal(size=8)
    ids = [7] * 100 + list(range(10, 40))
    block = neighbours._by_id(ids, [query + rng.normal(size=8) * (1e-6 if i == 7 else 0.3) for i in ids], 8)
    found = neighbours.best_of_block(block, 10, query, 5)
    assert len({i for i, _ in found}) == 5 and found[0][0] == 7 and 10 not in {i for i, _ in found}
    assert neighbours.best_of_block(neighbours._by_id([], [], 8), 10, query, 5) == []


def test_queries_with_few_probed_rows_are_completed(spark):
    """Tables that find hardly a neighbour: a small one, and a rare width beside a common one."""
    rng = np.random.default_rng(8)
    rows = [(50 * i, [float(x) for x in rng.normal(size=64).astype(np.float32)]) for i in range(1, 9)]
    rows += [(2000 + 50 * i, [float(x) for x in rng.normal(size=32).astype(np.float32)]) for i in range(3)]
    got = neighbours.nearest(frame(spark, rows).repartition(3), F.col("vec_id") % 50 == 0, Params(tables=1, probes=1, block_rows=3)).collect()
    by: dict[int, list] = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert by == exact(rows, 5, 50)
    assert len(by[50]) == 5 and len(by[2000]) == 2


def test_empty_table(spark):
    assert neighbours.nearest(frame(spark, []).limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_rotation_keeps_length_and_angles():
    x = np.random.default_rng(1).normal(size=(5, 64))
    y = neighbours.rotated(x, 3, Params())
    assert np.allclose(y @ y.T, (x @ x.T) * 64**3)


def test_doubles_of_any_size(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=4) * size]) for i, size in zip(range(50, 110), [1e200, 1e-200, 1e-320, 1e306, 1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0, Params(probes=99, tables=1)).collect()
    vectors = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    for q in (50, 100):
        score = {i: float(v @ vectors[q] / np.linalg.norm(v) / np.linalg.norm(vectors[q])) for i, v in vectors.items() if i != q}
        found = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [i for _, i, _ in found] == sorted(score, key=lambda i: -score[i])[:5]
        assert all(abs(s - score[i]) < 1e-9 for _, i, s in found)
