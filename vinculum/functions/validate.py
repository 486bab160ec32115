"""Per-field validation (V1-V10) as Column expressions.

Each field is checked on its own, so one bad value does not stop the others from being
promoted.  Two front ends produce the same ``(clean, error)`` pair per field:

* typed columns (parquet/table sources): a null value means the key was absent;
* VARIANT columns (JSON sources): absent key, JSON null and each JSON type are told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinculum import schemas as S
from vinculum.functions.text import fingerprint, join_errors, strip_unicode

TEXT_FIELDS = ("name", "producer", "category")
FIELDS = ("name", "producer", "category", "vintage", "size_ml")


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)

# Integer-like text: optional sign, digits with single underscores between them, and an
# optional run of zero decimals ("2010", "+2010", "2_010", "2010.0", "2010.").
_INT_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*(\.0*)?$"


def trimmed_columns(variant: bool = False) -> list[Column]:
    """Trimmed text of the three text fields as ``_t_<field>`` columns; of VARIANT columns also
    their types (``_k_<field>``), the two numbers as doubles (``_n_<field>``) and the vintage's
    trimmed text.

    Computed in their own projection so that each trim and cast runs once per row; the checks
    below refer to these columns from several places (clean value, error, status, fingerprint).
    """
    out = []
    for f in TEXT_FIELDS:
        text = F.try_variant_get(F.col(f), "$", "string") if variant else F.col(f)
        out.append(strip_unicode(text).alias(f"_t_{f}"))
    if variant:
        out += [_vtype(F.col(f)).alias(f"_k_{f}") for f in FIELDS]
        # As doubles, so that a number of any size is judged by its range; what passes is exact.
        out += [F.try_variant_get(F.col(f), "$", "double").alias(f"_n_{f}") for f in ("vintage", "size_ml")]
        out.append(strip_unicode(F.try_variant_get(F.col("vintage"), "$", "string")).alias("_t_vintage"))
    return out


def _text_check(present: Column, is_string: Column, trimmed: Column) -> tuple[Column, Column]:
    err = (
        F.when(~present, F.lit(S.MSG_REQUIRED))
        .when(~is_string, F.lit(S.MSG_STRING_TYPE))
        .when(F.length(trimmed) == 0, F.lit(S.MSG_STRING_EMPTY))
    )
    clean = F.when(err.isNull(), trimmed)
    return clean, err


def _range_check(iv: Column, vmax: int) -> Column:
    return F.when(iv < S.VINTAGE_MIN, F.lit(S.msg_vintage_low())).when(iv > vmax, F.lit(S.msg_vintage_high(vmax)))


def _size_check(present: Column, size_value: Column) -> tuple[Column, Column]:
    ok = size_value.isin(*S.SIZES_ML)
    err = F.when(~present, F.lit(S.MSG_REQUIRED)).when(~F.coalesce(ok, F.lit(False)), F.lit(S.MSG_SIZE))
    clean = F.when(err.isNull(), size_value.try_cast("int"))
    return clean, err


def typed_checks(vintage_max: int = S.VINTAGE_MAX) -> dict[str, tuple[Column, Column]]:
    """Checks for typed columns ``name producer category`` (string), ``vintage size_ml`` (int).

    Expects the :func:`trimmed_columns` next to the fields.
    """
    out: dict[str, tuple[Column, Column]] = {}
    for f in TEXT_FIELDS:
        out[f] = _text_check(F.col(f).isNotNull(), F.lit(True), F.col(f"_t_{f}"))
    v = F.col("vintage")
    v_err = _range_check(v, vintage_max)
    out["vintage"] = (F.when(v_err.isNull(), v.cast("int")), v_err)
    s = F.col("size_ml")
    out["size_ml"] = _size_check(s.isNotNull(), s)
    return out


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_int_type(t: Column) -> Column:
    return t.isin("BIGINT", "INT", "SMALLINT", "TINYINT")


def _is_numeric(t: Column) -> Column:
    return _is_int_type(t) | t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT")


def _has_fraction(number: Column) -> Column:
    return number % 1 != 0


def variant_checks(vintage_max: int = S.VINTAGE_MAX) -> dict[str, tuple[Column, Column]]:
    """Checks for VARIANT columns with the same names (see module docstring).

    Expects the :func:`trimmed_columns` next to the fields.
    """
    out: dict[str, tuple[Column, Column]] = {}
    for f in TEXT_FIELDS:
        v = F.col(f)
        is_str = F.coalesce(~F.is_variant_null(v) & (F.col(f"_k_{f}") == "STRING"), F.lit(False))
        out[f] = _text_check(v.isNotNull(), is_str, F.when(is_str, F.col(f"_t_{f}")))

    # vintage: optional; absent or JSON null -> null without error
    v = F.col("vintage")
    t = F.col("_k_vintage")
    missing = v.isNull() | F.is_variant_null(v)
    num = F.col("_n_vintage")
    text = F.col("_t_vintage")
    text_ok = text.rlike(_INT_TEXT)
    text_num = F.regexp_replace(F.regexp_replace(text, "_", ""), r"\.0*$", "").try_cast("double")
    iv = (
        F.when(_is_numeric(t) & ~_has_fraction(num), num)
        .when(t == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), F.lit(1.0)).otherwise(F.lit(0.0)))
        .when((t == "STRING") & text_ok, text_num)
    )
    type_err = (
        F.when(missing, _null("string"))
        .when(_is_numeric(t) & _has_fraction(num), F.lit(S.MSG_INT_FRACTION))
        .when((t == "STRING") & ~text_ok, F.lit(S.MSG_INT_PARSE))
        .when(~(_is_numeric(t) | t.isin("BOOLEAN", "STRING")), F.lit(S.MSG_INT_TYPE))
    )
    v_err = F.when(missing, _null("string")).otherwise(F.coalesce(type_err, _range_check(iv, vintage_max)))
    out["vintage"] = (F.when(missing | v_err.isNotNull(), _null("int")).otherwise(iv.try_cast("int")), v_err)

    # size_ml: required; a JSON number with an integral value in the allowed list
    s = F.col("size_ml")
    st = F.col("_k_size_ml")
    snum = F.col("_n_size_ml")
    size_value = F.when(
        F.coalesce(~F.is_variant_null(s) & _is_numeric(st) & ~_has_fraction(snum), F.lit(False)), snum
    )
    out["size_ml"] = _size_check(s.isNotNull(), size_value)
    return out


def record_fingerprint() -> Column:
    """The fingerprint of a validated record, null for an invalid one."""
    return F.when(F.col("validation_error").isNull(), fingerprint(*[F.col(f) for f in FIELDS]))


def with_fingerprint(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of rows that an import validated, the fingerprint computed from their fields."""
    return rows.select(*[record_fingerprint().alias(c) if c == "fingerprint" else c for c in columns])


def validated(rows: DataFrame, checks: dict[str, tuple[Column, Column]], keep: list[str], variant: bool = False) -> DataFrame:
    """The columns ``keep`` and those of a validated record: clean fields, status, validation_error,
    fingerprint (V9/V10).

    One projection for the checks of the fields and their messages, one for the whole message and
    one for what follows from it, so that each check is computed once a row.  With ``variant`` the
    list of messages goes through a higher-order function: Spark then compiles that projection on
    its own, in many small methods.  The checks of VARIANT fields, fused with their neighbours, are
    one method of over 8000 bytes, which the JVM never compiles but interprets; typed ones aren't.
    """
    errors = [F.concat(F.lit(f + ": "), checks[f][1]) for f in FIELDS]
    messages = [F.filter(F.array(*errors), lambda m: m.isNotNull())] if variant else errors
    named = [m.alias(f"_m_{i}") for i, m in enumerate(messages)]
    out = rows.select(*keep, *[checks[f][0].alias(f) for f in FIELDS], *named)
    out = out.select(*keep, *FIELDS, join_errors(*[F.col(f"_m_{i}") for i in range(len(messages))]).alias("validation_error"))
    valid = F.col("validation_error").isNull()
    return out.select(
        *keep,
        *FIELDS,
        F.when(valid, F.lit("pending")).otherwise(F.lit("invalid")).alias("status"),
        "validation_error",
        record_fingerprint().alias("fingerprint"),
    )
