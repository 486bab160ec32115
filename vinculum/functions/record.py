"""JSON records as VARIANT: whole record, id, and the fields with their JSON types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("name", "producer", "category", "vintage", "size_ml")


def with_id(df: DataFrame, text: str = "raw_json") -> DataFrame:
    """Adds submission_id, id_invalid and record_invalid from the record text of each row.

    A text that is no JSON object, or has anything behind the object, is an invalid record; a
    JSON-string id becomes the id; any other id that is not null is invalid.

    The JSON parser stops behind the first value.  So the text is parsed as the one element of a
    list: then only a closing bracket can follow the object unseen, and a text that could
    have one is parsed as a field of an object, too, where a bracket can't follow.  That the value
    is an object is told by its first character.
    """
    df = df.withColumn("_list", F.try_parse_json(F.concat(F.lit("["), F.col(text), F.lit("]"))))
    alone = F.try_variant_get("_list", "$[1]", "variant").isNull()
    field = F.try_parse_json(F.concat(F.lit('{"r":'), F.col(text), F.lit("}")))
    closed = F.when(F.col(text).rlike(r"\}\s*\]"), field.isNotNull()).otherwise(F.lit(True))
    good = F.coalesce(F.col("_list").isNotNull() & F.col(text).rlike(r"^[ \t\r\n]*\{") & alone & closed, F.lit(False))
    df = df.withColumn("record_invalid", ~good).withColumn("_id", F.when(good, F.try_variant_get("_list", "$[0].submission_id", "variant")))
    v = F.col("_id")
    is_string = F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))
    missing = v.isNull() | F.coalesce(F.is_variant_null(v), F.lit(True))
    df = df.withColumn("id_invalid", ~missing & ~is_string).withColumn("submission_id", F.when(is_string, F.try_variant_get(v, "$", "string"))).drop("_list", "_id")
    return _computed_once(df, "submission_id", "id_invalid", "record_invalid")


def _computed_once(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``columns`` through the explode of a list of one.

    A filter on a computed column moves below the projections with a copy of everything it is
    computed from, for a record's flags some thirty parses of its text.  It doesn't move below
    an explode.
    """
    others = [c for c in df.columns if c not in columns]
    one = F.array(F.struct(*[F.col(c) for c in columns]))
    return df.select(*[F.col(f"`{c}`") for c in others], F.explode(one).alias("_one")).select(*[F.col(f"`{c}`") for c in others], "_one.*")


def with_fields(df: DataFrame, text: str = "raw_json") -> DataFrame:
    """Adds the five fields as VARIANT columns: absent is a SQL null, JSON null a variant null."""
    df = df.withColumn("_record", F.try_parse_json(F.col(text)))
    return df.select("*", *[F.try_variant_get("_record", f"$.{f}", "variant").alias(f) for f in FIELDS]).drop("_record")
