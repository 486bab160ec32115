"""Skew-safe exact dedup on full content, built-in functions only.

Texts are equal when identical after deleting space and 0x09-0x0D; null counts as empty.  Of
equal texts the row with the most code points in its original text stays, then the smallest
doc_id (a null doc_id ranks last).

1. *Local.* Partial aggregation keyed by (digest, salt, content, length) combines copies
   inside every scan task, before anything is shuffled.
2. *Salted.* The shuffle on that key merges the tasks' winners; a group of any size is spread
   over `salts` reducers.
3. *Global.* At most `salts` winners per content and length are combined on (digest, content).

The content itself is a grouping key at each of these stages, so a digest collision never
merges different texts.  Members then find their group by digest; digests that stand for
several contents (checked on the group table) are joined on the content as well.

Defined results: an empty table gives an empty result; where the id that stays is repeated by
rows of the same length, `kept` is true for one of them only, and `deduplicate` leaves the one
whose original has the greatest SHA-256 (wholly equal rows are interchangeable); texts without
a character besides white space are one group with the empty ones; very long texts are
compared whole; extra columns pass through `deduplicate` untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinculum.llm.common import SPACE, fresh, stage

SALTS = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, content, keep_id, keep_chars, group_size) from (doc_id, chars, content, digest)."""
    salt = F.pmod(F.xxhash64("doc_id", "chars"), F.lit(salts)).cast("int")
    salted = rows.groupBy("digest", salt.alias("salt"), "content", "chars").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    # Longer first, then smaller id; one number, so that the aggregate stays a hash aggregate.
    rank = F.col("chars").cast("decimal(10,0)") * F.lit(str(2**64)).cast("decimal(20,0)") - F.coalesce("id", F.lit(2**63 - 1)).cast("decimal(19,0)")
    return salted.groupBy("digest", "content").agg(F.max_by("id", rank).alias("keep_id"), F.max("chars").alias("keep_chars"), F.sum("n").alias("group_size"))


def members(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest: one row per row of `docs` (doc_id, text)."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.length(text), F.lit(0)).alias("chars"), normalised(text).alias("content")).withColumn("digest", digest(F.col("content")))
    slim = rows.select("doc_id", "chars", "digest")
    winners = stage(groups(rows, salts).drop("content"), "exact-groups")
    shared = winners.groupBy("digest").count().filter("count > 1").select("digest")
    if shared.isEmpty():
        found = slim.join(winners, "digest")
    else:
        shared = stage(shared, "exact-shared-digests")
        plain = slim.join(winners.join(shared, "digest", "left_anti"), "digest")
        again = rows.join(shared, "digest", "left_semi")
        full = stage(groups(again, salts), "exact-shared-contents")
        found = plain.withColumn("content", F.lit("")).unionByName(again.join(full, ["digest", "content"]))
    # Rows of the id that stays: one is kept, however often the id is repeated.
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    columns = ["doc_id", "keep_id", "group_size", "digest", *(["content"] if "content" in found.columns else [])]
    found = stage(found.withColumn("kept", stays).select(*columns, "kept"), "exact-members")
    several = found.filter("kept").groupBy(columns).agg(F.count("*").alias("n"))
    kept = several.withColumn("kept", F.explode(F.concat(F.array(F.lit(True)), F.array_repeat(F.lit(False), (F.col("n") - 1).cast("int")))))
    rows = found.filter("not kept").unionByName(kept.select(found.columns))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "digest")


def deduplicate(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    id_, digest, chars, row = (fresh(docs, n) for n in ("_id", "_digest", "_chars", "_row"))
    id_key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias(id_)
    keepers = stage(members(docs.select("doc_id", "text"), salts).filter("kept").select(id_key, F.col("digest").alias(digest)).distinct(), "exact-kept")
    text = F.col("text").cast("string")
    rows = docs.select("*", id_key, sha256(normalised(text)).alias(digest), F.coalesce(F.length(text), F.lit(0)).alias(chars))
    # Rows that repeat the id of the one that stays: the longest original, one of equals.  The
    # join has already brought them together, so this needs no further shuffle.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    best = rows.join(keepers, [id_, digest]).groupBy(id_, digest).agg(F.max_by(whole, F.struct(F.col(chars), sha256(F.coalesce(text, F.lit(""))))).alias(row))
    return best.select(*[F.col(row)[c].alias(c) for c in docs.columns])
