"""Scalar text functions as Column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex: every run of characters that is neither a letter nor a number.
_NON_ALNUM = r"[^\p{L}\p{N}]+"
# Unicode White_Space at either end ((?U) makes \s Unicode-aware in Java).
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def normalize(c: Column) -> Column:
    """Lower-case, non-alphanumerics become spaces, runs collapse, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), _NON_ALNUM, " "))


def tokens(norm: Column) -> Column:
    """The distinct tokens of a normalized string; the empty string gives ``[]``."""
    return F.array_distinct(F.filter(F.split(norm, " "), lambda t: t != ""))


def name_tokens(c: Column) -> Column:
    return tokens(normalize(c))


def strip_unicode(c: Column) -> Column:
    """Trim Unicode White_Space at both ends (``F.trim`` only removes U+0020)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def producer_key(c: Column) -> Column:
    """Case-folded producer, the catalog lookup key."""
    return F.lower(c)


def alias_key(c: Column) -> Column:
    """J4 key: ``lower(strip(producer))``."""
    return F.lower(strip_unicode(c))


def fingerprint(name: Column, producer: Column, category: Column, vintage: Column, size_ml: Column) -> Column:
    """sha256 hex of ``name|producer|category|vintage-or-empty|size``, case-sensitive.

    Takes validated values, which are already trimmed (X3), so no second trim is needed.
    """
    payload = F.concat_ws(
        "|",
        name,
        producer,
        category,
        F.coalesce(vintage.cast("string"), F.lit("")),
        size_ml.cast("string"),
    )
    return F.sha2(payload, 256)


def packed_hex(text: Column) -> Column:
    """A text as binary: lower-case hex in half its length, anything else as it is, told apart by
    the first byte; equal exactly for equal texts.  :func:`unpacked_hex` gives the text back."""
    digits = F.unhex(text)
    return F.when(F.lower(F.hex(digits)) == text, F.concat(F.lit(b"h"), digits)).otherwise(F.concat(F.lit(b"t"), text.cast("binary")))


def unpacked_hex(packed: Column) -> Column:
    """The text that :func:`packed_hex` was given."""
    payload = F.substring(packed, F.lit(2), F.length(packed))
    return F.when(F.substring(packed, F.lit(1), F.lit(1)) == F.lit(b"h"), F.lower(F.hex(payload))).otherwise(payload.cast("string"))


def join_errors(*errors: Column) -> Column:
    """Non-null messages joined with ``"; "``; null when there are none."""
    joined = F.concat_ws("; ", *errors)
    return F.when(joined == "", F.lit(None).cast("string")).otherwise(joined)


def percent(num: Column, den: Column) -> Column:
    """``12.5%`` with one decimal (round half even on the exact value), ``-`` for 0."""
    value = F.bround(num.cast("double") / den.cast("double") * 100.0, 1)
    return F.when(den == 0, F.lit("-")).otherwise(F.concat(F.format_string("%.1f", value), F.lit("%")))


def first_or_null(arr: Column) -> Column:
    """First element of an array, null for an empty or null array."""
    return F.try_element_at(arr, F.lit(1))
