"""Registered queries of the training-data operators: one per operator, whole tables.

`TOKENIZERS` is the folder of public tokenizer files, a parameter of the environment.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum.llm import bpe, byte_bpe, exact_dedup, language, licenses, merkle, near_dedup, neighbours, packing, periodic, quality, sharding, wordpiece
from vinculum.llm.common import stage, table


def tokenizer_file(name: str) -> str:
    """Path of a tokenizer file: in $TOKENIZERS if set, else of the installed public package."""
    folder = os.environ.get("TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page: trigram text evidence, declared language, address, host prior."""
    labelled = table(spark, sf_dir, "documents").select("text", "lang")
    p = language.with_labelled(labelled)
    model = language.learn(labelled, p)
    return language.identify(language.page_rows(table(spark, sf_dir, "pages")), model, p).withColumn("confidence", F.round("confidence", 9))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that are the whole text, or a line, of each document."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.registry(spark))


def op3_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards, counts at most one apart."""
    return sharding.shards(table(spark, sf_dir, "documents"), 24)


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of `documents`: three-word shingles, similarity at least 0.85."""
    return near_dedup.components_of(table(spark, sf_dir, "documents"), near_dedup.Params(words=3, percent=85))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal without white space."""
    return exact_dedup.members(table(spark, sf_dir, "documents")).withColumnRenamed("digest", "text_sha256")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op7_cross_polytope_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest embeddings of every vec_id divisible by 50."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document."""
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_wordpiece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), wordpiece.vocabulary(tokenizer_file("byte_bpe_50k.json")))


def op10_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality.with_score(docs, model)
    return stage(scored.select(F.col("doc_id").cast("long").alias("doc_id"), quality.held_out(F.col("doc_id")).alias("held_out"), "score", quality.predicted(model, F.col("score")).alias("predicted")), "quality-scores")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root after its tampering."""
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.regexp_replace(F.col("text").cast("string"), "\n", "")).otherwise(F.col("text").cast("string"))
    found = merkle.manifest(docs, tampered=tampered)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, a tenth of them with a periodic tail."""
    return periodic.run_digests(table(spark, sf_dir, "documents"), change=periodic.plant)


def op13_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level ids of every document and the digest of what they decode to."""
    import public_tokenizers

    vocabulary = byte_bpe.Vocabulary.read(tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = byte_bpe.encode(docs, vocabulary, keep=["doc_id"])
    return stage(
        coded.select(
            "doc_id",
            F.size("ids").cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
            F.sha2(byte_bpe.decoded(F.col("ids"), vocabulary), 256).alias("decoded_sha256"),
        ),
        "byte-bpe-digests",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_license_scan,
        op3_feistel_sharding,
        op4_minhash_near_dedup,
        op5_exact_dedup,
        op6_best_fit_packing,
        op7_cross_polytope_neighbours,
        op8_bpe_round_trip,
        op9_wordpiece_counts,
        op10_compression_quality,
        op11_merkle_manifest,
        op12_periodic_runs,
        op13_byte_level_bpe,
    )
}


def _license_sql() -> str:
    """The licence scan in SQL: canonical lines by the same patterns, digests, hash joins."""

    def canonical(lines: str) -> str:
        kept = f"array_to_string(list_filter({lines}, lambda l: NOT regexp_matches(l, '{licenses.COPYRIGHT_LINE}')), chr(10))"
        out = f"regexp_replace({kept}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
        for pattern, replacement in licenses.SPELLINGS:
            out = f"regexp_replace({out}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
        return f"list_filter(list_transform(string_split({out}, chr(10)), lambda l: trim(l)), lambda l: l <> '')"

    lines = "string_split(lower(coalesce(text, '')), chr(10))"
    known = [(name, text.replace("'", "''")) for name, text in (*licenses.license_texts(), *licenses.NOTICES)]
    values = ", ".join(f"('{name}', '{text}')" for name, text in known)
    return f"""
WITH known AS (SELECT sha256(c) AS digest, min(license_id) AS license_id
               FROM (SELECT license_id, array_to_string({canonical(lines)}, ' ') AS c FROM (VALUES {values}) v(license_id, text)) WHERE c <> '' GROUP BY 1),
lined AS (SELECT row_number() OVER () AS r, doc_id, {canonical(lines)} AS lines FROM documents),
whole AS (SELECT r, doc_id, sha256(array_to_string(lines, ' ')) AS text_digest FROM lined),
notice AS (SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices, count(*) AS n_notices
           FROM (SELECT r, sha256(unnest(lines)) AS digest FROM lined) JOIN known USING (digest) GROUP BY r)
SELECT doc_id, text_digest, license_id, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM whole LEFT JOIN known ON text_digest = digest LEFT JOIN notice USING (r)"""


#: DuckDB SQL by query, where SQL can express the operator over whole tables.
ORACLES: dict[str, str] = {
    "op2_license_scan": _license_sql(),
    "op5_exact_dedup": """
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS content FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY content) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM g""",
}
