"""Corpus pipeline over `documents`.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame; `run` writes each stage's rows as a Parquet table in the shared scratch folder and
reads them back as the next stage's input.  All stages but the last return the columns of
`documents`.  A repeated doc_id, a null column, an empty text or an empty table is handled as
the operators' docstrings say; extra columns pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vinculum.llm import exact_dedup, language, near_dedup, packing, quality
from vinculum.llm.common import stage, table
from vinculum.llm.queries import tokenizer_file


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject."""
    model = quality.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the known languages; texts in none go."""
    return language.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal without white space."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good),
    ("language", identified),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("packing", packed),
]

#: The stages learn from data, hash and pack; SQL can't express them. Tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
