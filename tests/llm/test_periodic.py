"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.samples import documents, edge_rows, prose
from vinculum.llm import periodic
from vinculum.llm.queries import op12_periodic_runs


def brute(words: list) -> list[tuple[int, int, int]]:
    """Every maximal stretch of every period that is its smallest."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            part = words[start:j]
            smallest = next(d for d in range(1, q + 1) if part[d:] == part[:-d])
            if smallest == q and length >= max(6, 4 * q):
                found.append((start, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_runs_of_small_alphabets(numbers):
    words = [b"%d" % x for x in numbers]
    assert periodic.runs(words) == brute(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 7), st.integers(0, 6)), max_size=8))
def test_runs_of_repeated_blocks(blocks):
    words = [b"%d" % x for block, times, cut in blocks for x in (block * times)[: max(1, len(block) * times - cut)]]
    assert periodic.runs(words) == brute(words)


def test_runs_among_prose():
    rng = random.Random(12)
    for _ in range(60):
        words = prose(rng, rng.randint(0, 300), "abc").encode().split()
        for _ in range(rng.randint(0, 4)):
            at, size, times = rng.randint(0, len(words)), rng.randint(1, 30), rng.randint(1, 9)
            words[at:at] = words[at : at + size] * times
        assert periodic.runs(words) == brute(words)


def test_the_automaton_knows_last_ends():
    rng = random.Random(3)
    words = [rng.randint(0, 2) for _ in range(200)]
    automaton = periodic.Automaton(words)
    tree = periodic.Accessed(automaton)
    for i in range(len(words)):
        found: dict[int, int] = {}
        for before, longest in tree.access(automaton.prefix[i], i):
            found[before] = max(found.get(before, 0), longest)
        expected: dict[int, int] = {}
        for size in range(1, i + 1):  # latest earlier end of each suffix
            end = next((e for e in range(i - 1, size - 2, -1) if words[e - size + 1 : e + 1] == words[i - size + 1 : i + 1]), None)
            if end is not None:
                expected[end] = max(expected.get(end, 0), size)
        assert {e: x for e, x in found.items() if x} == expected


def test_strongest_and_collapsed():
    words = b"a b a b a b a b x y y y y y y y y".split()
    found = periodic.runs(words)
    assert found == [(0, 8, 2), (9, 8, 1)] == brute(words)
    assert periodic.strongest(found) == (9, 8, 1)
    assert periodic.collapsed(words, found) == b"a b x y".split()
    assert periodic.strongest([(0, 8, 2), (10, 4, 1)]) == (0, 8, 2)  # a tie: the first
    assert periodic.strongest([]) is None and periodic.collapsed(words, []) == words


def test_parameters():
    words = b"a a a a a a a".split()
    assert periodic.runs(words, periodic.Params(least_words=8)) == []
    assert periodic.runs(words, periodic.Params(least_times=7)) == [(0, 7, 1)]
    with pytest.raises(ValueError):
        periodic.Params(least_times=3)


def expected_row(doc_id: int | None, text: str | None) -> tuple:
    words = (text or "").encode().split()
    if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0 and words:
        n, g = len(words), zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words) if len(words) < 2000 else periodic.runs(words)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    text = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (
        doc_id,
        len(found),
        *best,
        best[1] and best[1] * 1000 // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(text).hexdigest(),
    )


def test_query_on_edge_rows(spark, tmp_path):
    rng = random.Random(5)
    rows = edge_rows(rng)
    rows += [(i, " ".join(rng.choices("ab", k=rng.randint(0, 40)))) for i in range(20, 90)]
    rows += [(90, "x " * 5000), (91, "word " + "y" * 100_000 + " z z z z z z")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((expected_row(*r[:2]) for r in rows), key=repr)
    documents(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op12_periodic_runs(spark, f"{tmp_path}/none").count() == 0


def test_whole_runs_and_texts(spark):
    rows = periodic.periodic_runs(documents(spark, [(1, "a b a b a b a b c"), (2, None)])).collect()
    assert [(r["doc_id"], r["n_runs"], [tuple(x) for x in r["runs"]], bytes(r["collapsed"])) for r in rows] == [(1, 1, [(0, 8, 2)], b"a b c"), (2, 0, [], b"")]


def test_stretches_are_few_in_plain_prose():
    words = np.arange(5000) % 1777  # repeats, but no run
    assert sum(hi - lo for lo, hi in periodic.stretches(words)) > 0
    assert periodic.runs([b"%d" % x for x in words]) == []
