"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.samples import documents, edge_rows, prose
from vinculum.llm import byte_bpe
from vinculum.llm.queries import op13_byte_level_bpe, tokenizer_file


@pytest.fixture(scope="module")
def vocabulary() -> byte_bpe.Vocabulary:
    return byte_bpe.Vocabulary.read(tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def texts() -> list[str | None]:
    rng = random.Random(13)
    marks = "aAbeE 'sStTdDlmreve019.,!?-_|<>\n\t\r\x0b\x1c\x1f\x85\xa0éßİΣ中文字😀👍🏽  　ªⅫ٣"
    some = ["".join(rng.choices(marks, k=rng.randint(0, 50))) for _ in range(150)]
    some += [prose(rng, 200), "  leading and trailing  ", "a\n\n\nb   c \n ", "I'll we've 'S 'RE it's", "x" * 80, "ab" * 40, " " * 70, "=" * 55 + "1" * 50, "<|endoftext|>", "", None]
    return some + ["".join(rng.choices("abcdefgh", k=rng.randint(60, 90))) for _ in range(4)]


def test_the_fold_equals_the_library(spark, vocabulary, library):
    rows = list(enumerate(texts()))
    docs = documents(spark, rows).withColumn("ids", F.lit("clash"))
    expected = {i: library.encode_ordinary(t or "") for i, t in rows}
    assert {r["doc_id"]: r["ids"] for r in byte_bpe.encode_by_fold(docs, vocabulary).collect()} == expected
    for size in (0, 50):
        assert {r["doc_id"]: r["ids"] for r in byte_bpe.encode(docs, vocabulary, lexicon_size=size).collect()} == expected


def test_long_words(spark, vocabulary, library):
    rng = random.Random(4)
    long = ["x" * 300, "=" * 5000 + " plain words " + "-" * 300, "".join(rng.choices("abcdefgh", k=3000)) * 2, " " * 40_000 + "é" * 9000, "short"]
    rows = list(enumerate(long))
    got = byte_bpe.encode(documents(spark, rows), vocabulary)
    assert "text" in got.columns and {r["doc_id"]: r["ids"] for r in got.collect()} == {i: library.encode_ordinary(t) for i, t in rows}


def test_merging_equals_the_library(vocabulary, library):
    merger = byte_bpe.ByteMerger(vocabulary.ranks)
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdeéxyz 'stI=-", k=rng.randint(1, 90))).encode() for _ in range(600)]
    words += [word for word in vocabulary.ranks if len(word) > 1][::50]
    assert merger.many(words) == [library._encode_single_piece(w) for w in words]


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_literal_map(spark, n):
    rng = random.Random(n)
    entries = {rng.randbytes(rng.randint(0, 6)): i for i in range(n)}
    keys = [*entries, *(rng.randbytes(4) for _ in range(50)), b""]
    literal = byte_bpe.LiteralMap(entries, "int")
    got = spark.createDataFrame([(keys,)], "k array<binary>").select(literal.get(F.col("k")).alias("v")).first()["v"]
    assert got == [entries.get(k) for k in keys]
    moves, slots = literal._placed(np.array([7, 7 + (1 << 30)] * (n > 0), np.uint64), 1024) or ([], [])
    assert len(set(slots)) == len(slots)


def test_query_on_edge_rows(spark, tmp_path, library):
    rows = edge_rows(random.Random(8)) + list(enumerate(texts()[-30:], 100))
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
        assert library.decode_bytes(ids) == (text or "").encode()
    got = [tuple(r) for r in op13_byte_level_bpe(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    documents(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op13_byte_level_bpe(spark, f"{tmp_path}/none").count() == 0
