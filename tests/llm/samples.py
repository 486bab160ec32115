"""Small made-up tables for the operator tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Documents with extra columns whose names the operators use inside.
DOCUMENT = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept boolean, component_id long, digest string, score double, _key string, _id string, _digest int, host string, row int"
)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, lang[, source]]) with every other column filled."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, *("en", "src1")[len(row) - 2 :])
        full.append((doc_id, text, lang, source, len(text or ""), None, 7, "d", 0.5, "k", "i", 1, "h", 3))
    return spark.createDataFrame(full, DOCUMENT)


def prose(rng: random.Random, n: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(n))


def edge_rows(rng: random.Random) -> list[tuple]:
    """Nulls, empties, repeats, very long texts, words of odd bytes."""
    base = prose(rng, 60)
    long = prose(rng, 400_000)  # over two slices of text
    return [
        (1, base),
        (2, base.upper()),
        (2, base.upper()),
        (3, None),
        (4, ""),
        (5, " \t\n\x0b\x0c\r "),
        (6, "one"),
        (7, "one  two"),
        (8, long),
        (9, long + " tail"),
        (10, "x" * 3000),
        (None, base),
        (None, None),
        (11, base.replace(" ", "\n\t")),
        (12, "Ünïcode   naïve\x1cword é \U0001f600 <|endoftext|>x<|ENDOFTEXT|> it's 'S 123"),
        (13, base, None, None),
    ]
