"""BPE lexicon and merging, word-piece counts and packing against the library and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.samples import documents, edge_rows, prose
from vinculum.llm import bpe, packing, tokens, wordpiece
from vinculum.llm.queries import tokenizer_file

WORDS = tokenizer_file("word_bpe_49k.json")


def library_ids(text: str | None) -> list[int]:
    return tokens.tokenizer(WORDS).encode(text or "", add_special_tokens=False).ids


def merged(text: str) -> list[int]:
    exact = bpe.merger(WORDS)
    return [i for c in tokens.chunks(text.encode()) for i in exact.ids(c)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAeiE 'sStTdD<|>́İΣͅ\x1c\x85  \n")), max_size=60))
def test_merging_equals_the_library(text):
    assert merged(text) == library_ids(text)
    table = tokens.chunk_ids(WORDS)
    assert table.ids(tokens.chunks(text.encode()))[0].tolist() == library_ids(text)


def test_kept_chunks_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 40)
    rng = random.Random(21)
    table = tokens.LibraryIds(WORDS)
    words = [prose(rng, 1) for _ in range(30)]
    for _ in range(60):  # runs over the bound again and again
        text = " ".join(rng.choices(words, k=20) + [prose(rng, 5)])
        ids, ends = table.ids(tokens.chunks(text.encode()))
        assert ids.tolist() == library_ids(text) and ends[-1] == len(ids)
        assert len(table.at) <= 40 + 25
    table.shrink()
    assert table.ids(tokens.chunks(text.encode()))[0].tolist() == library_ids(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>B", "İİ ΑΣ Σ", "a" * 5000, "ab" * 3000, "x'S y'll'RE 12 3!!", "\x00\x01\x7f"])
def test_merging_corners(text):
    assert merged(text) == library_ids(text)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=9), st.lists(st.integers(0, 9), max_size=3), max_size=60), st.lists(st.binary(max_size=12), max_size=30))
def test_lexicon_gives_exactly_its_entries(entries, others):
    lexicon = bpe.Lexicon(bpe.compile_lexicon(entries))
    words = [*entries, *others]
    for word, number in zip(words, lexicon.numbers(words).tolist()):
        assert (number >= 0) == (word in entries)
        if number >= 0:
            assert lexicon.ids_of(number) == entries[word]


def test_lexicon_shares_suffixes():
    words = {(a + b).encode(): [1] for a in ("walk", "talk", "jump") for b in ("", "s", "ed", "ing")}
    array = bpe.compile_lexicon(words)
    assert array[0] < 25  # a trie has 32 edges


def test_encode_equals_the_library(spark):
    rng = random.Random(11)
    rows = edge_rows(rng) + [(100 + i, prose(rng, 50)) for i in range(20)]
    for size in (0, 50, 5000):
        got = bpe.encode(documents(spark, rows).repartition(3), WORDS, size).collect()
        expected = []
        for doc_id, text, *_ in rows:
            ids = library_ids(text)
            decoded = tokens.tokenizer(WORDS).decode(ids, skip_special_tokens=False)
            expected.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert bpe.encode(documents(spark, []).limit(0), WORDS).count() == 0


def greedy(word: bytes, vocabulary: set[bytes]) -> int:
    word, at, n = b" " + word, 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


@settings(max_examples=80, deadline=None)
@given(st.sets(st.text("ab ", min_size=1, max_size=6), max_size=25), st.lists(st.text("abc", min_size=1, max_size=14), min_size=1, max_size=12))
def test_automaton_equals_greedy_matching(entries, words):
    vocabulary = {e.encode() for e in entries if " " not in e[1:]}
    words = [w.encode() for w in words]
    assert wordpiece.Automaton(vocabulary).counts(words).tolist() == [greedy(w, vocabulary) for w in words]


def test_automaton_equals_the_library_word_pieces():
    from tokenizers import models

    entries = wordpiece.vocabulary(tokenizer_file("byte_bpe_50k.json"))
    vocabulary, rng = set(entries), random.Random(3)
    words = ["".join(rng.choices("abcdehilnorst", k=rng.randint(1, 15))) for _ in range(300)]
    plain = {e.decode() for e in entries if e.isascii() and e.decode().isprintable()}
    pieces = {(e[1:] if e[0] == " " else "##" + e): i for i, e in enumerate(sorted(plain)) if len(e) > 1 or e != " "}
    library = models.WordPiece(pieces, unk_token="[UNK]", max_input_chars_per_word=100)
    automaton = wordpiece.Automaton(vocabulary)
    for word, n in zip(words, automaton.counts([w.encode() for w in words]).tolist()):
        assert n == greedy(word.encode(), vocabulary)
        if " " + word[0] in plain:
            assert n == len(library.tokenize(word))


def test_token_counts_of_documents(spark):
    rng = random.Random(12)
    entries = wordpiece.vocabulary(tokenizer_file("byte_bpe_50k.json"))
    rows = [r for r in edge_rows(rng) if r[0] not in (8, 9)]
    got = wordpiece.token_counts(documents(spark, rows).repartition(3), entries).collect()
    expected = []
    for doc_id, text, *_ in rows:
        words = (text or "").encode().split()
        expected.append((doc_id, len(words), sum(greedy(w, set(entries)) for w in words)))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    long = documents(spark, [r for r in edge_rows(rng) if r[0] in (8, 9)])
    assert {r["doc_id"]: r["n_words"] for r in wordpiece.token_counts(long, entries).collect()} == {8: 400_000, 9: 400_001}
    assert wordpiece.token_counts(documents(spark, []).limit(0), entries).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_decreasing_equals_a_linear_search(lengths):
    lengths = sorted(lengths, reverse=True)
    room: list[int] = []
    for n in lengths:  # the tightest open sequence, found by looking at all
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(20 - n)
    placed = packing.best_fit_decreasing(lengths, 20)
    used: dict[int, int] = {}
    for n, (sequence, offset) in zip(lengths, placed):
        assert used.get(sequence, 0) == offset
        used[sequence] = offset + n
    assert all(v <= 20 for v in used.values())
    assert sorted(20 - v for v in used.values()) == sorted(room)


def test_pack_holds_every_token_once(spark):
    rng = random.Random(13)
    rows = edge_rows(rng) + [(1000 + i, prose(rng, rng.randint(1, 400))) for i in range(200)]
    p = packing.Params(group_pieces=150)
    got = packing.pack(documents(spark, rows).repartition(4), WORDS, p).collect()
    ids = {}
    for doc_id, text, *_ in rows:
        ids.setdefault(doc_id, np.array([*library_ids(text), 0], "<u4"))
    repeats = {i: sum(r[0] == i for r in rows) for i in ids}
    by: dict[int, list[tuple[int, int]]] = {}
    total: dict[int, int] = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if r["doc_id"] is None:
            continue
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] <= p.length and r["start"] == r["piece"] * p.length
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    assert total == {i: len(x) * repeats[i] for i, x in ids.items() if i is not None}
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= p.length
    tokens_in_all = sum(r["length"] for r in got)
    assert len(by) <= 1.05 * -(-tokens_in_all // p.length) + 2
    assert packing.pack(documents(spark, []).limit(0), WORDS).count() == 0


def test_long_words_cost_a_step_a_byte():
    import time

    rng = random.Random(5)
    vocabulary = [b" a", b"a", b"ab", b"abab", b"b", b" ba", b"baab", b"abba"]
    automaton = wordpiece.Automaton(vocabulary)
    words = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (47, 48, 49, 300, 2000)]
    words += [words[-1] + b"c", b"c" + words[-1], b"ab" * 400]
    assert automaton.counts(words).tolist() == [greedy(w, vocabulary) for w in words]
    whole = wordpiece.Automaton(wordpiece.vocabulary(tokenizer_file("byte_bpe_50k.json")))
    start = time.monotonic()
    counts = whole.counts([b"x" * 1_000_000, bytes(rng.choice(b"abcdefgh") for _ in range(1_000_000))])
    assert counts.min() > 1 and time.monotonic() - start < 4
