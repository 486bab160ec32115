"""Licence scan by canonical digest lookup, built-in functions only.

A text is put into canonical form - lower case, copyright lines dropped, equivalent spellings
united, every run of other than letters and digits one space - and the SHA-256 of the result
is hash-joined to the digests of known licences.  Whole texts are looked up, and so is each of
their lines as a text of its own, which finds the one-line notices in which documents name
their licence.  Known licences go through the same expression, so both sides always agree.

The default registry holds two kinds of entries: the licence texts of the folder
`licence_texts`, each with and without its customary title and with and without its appendix,
and the one-line `NOTICES`.  A licence that is in neither, or in another wording, is not found.
The registry is a parameter, small by nature; it is broadcast while it has at most
`BROADCAST_ENTRIES` rows (a digest and a name each) and shuffled beyond.

Defined results: null and empty texts and texts of copyright lines alone have an empty
canonical form, which matches nothing; repeated rows and null doc_ids are scanned each for
itself; registry entries with equal canonical forms resolve to the smallest name; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One-line licence notices by SPDX-style name.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
)

#: Title lines that may stand before a licence text whose file has none.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License"),
    "ISC": ("ISC License", "ISC License (ISC)", "The ISC License"),
    "MIT": ("MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)"),
}

#: What follows a licence's terms (how to apply it) starts after or at these.
TERMS_END = "END OF TERMS AND CONDITIONS"
ADDENDUM = "ADDENDUM: How to use this License"

#: A copyright line, from its start (after comment marks) on.
COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright|\(c\)|©|all rights reserved)"

#: Equivalent spellings (pattern, replacement), on canonical words.
SPELLINGS = (
    (r"\blicen[cs]e(d|s|e|es|r|rs)?\b", "license$1"),
    (r"\blicen[cs]ing\b", "licensing"),
    (r"\b(\w{3,})is(e|ed|es|ing|ation|ations)\b", "$1iz$2"),
    (r"\b(col|fav|hon|lab|behavi)our", "$1or"),
    (r"\bsub licens", "sublicens"),
    (r"\bnon commercial", "noncommercial"),
    (r"\bper cent\b", "percent"),
    (r"\bhttps\b", "http"),
    (r"\bv(ersion)? ?(\d)", "version $2"),
)

BROADCAST_ENTRIES = 10_000


def canonical_lines(text: Column) -> Column:
    """Canonical form of a text, line by line: an array of its non-empty canonical lines."""
    lines = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\n")
    kept = F.array_join(F.filter(lines, lambda l: ~l.rlike(COPYRIGHT_LINE)), "\n")
    out = F.regexp_replace(kept, r"[^\p{L}\p{N}\n]+", " ")
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.filter(F.transform(F.split(out, r"\n"), lambda l: F.trim(l)), lambda l: l != "")


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def license_texts() -> list[tuple[str, str]]:
    """(license_id, text) of every known wording; a file is named by its licence, up to `.txt` or a variant."""
    found = []
    for file in sorted(resources.files("vinculum.llm").joinpath("licence_texts").iterdir(), key=lambda f: f.name):
        name = file.name.removesuffix(".txt").removesuffix(".regents")
        whole = file.read_text(encoding="utf-8")
        terms = [whole]
        if TERMS_END in whole:
            before = whole[: whole.index(TERMS_END)]
            terms += [before, before + TERMS_END]
        if ADDENDUM in whole:
            terms.append(whole[: whole.index(ADDENDUM)])
        found += [(name, text) for text in terms]
        found += [(name, f"{title}\n\n{whole}") for title in TITLES.get(name, ())]
    return found


def registry(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """license_digest, license_id of known licences (license_id, text); licence texts and notices by default."""
    known = known if known is not None else spark.createDataFrame([*license_texts(), *NOTICES], "license_id string, text string")
    rows = known.select("license_id", F.array_join(canonical_lines(F.col("text")), " ").alias("canonical")).filter("canonical <> ''")
    return rows.groupBy(digest(F.col("canonical")).alias("license_digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, text_digest, license_id, notices, n_notices: one row per row of `docs`.

    license_id: the licence that the whole text is; notices: names of the licences whose whole
    text is a line of the text, sorted, joined by commas; n_notices: how many such lines.
    """
    entries = known.count()
    known = F.broadcast(known) if entries <= BROADCAST_ENTRIES else known
    lined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_row"), canonical_lines(F.col("text")).alias("_lines"))
    units = lined.select("doc_id", "_row", F.array_join("_lines", " ").alias("_whole"), "_lines")
    units = units.select(
        "doc_id",
        "_row",
        F.explode(
            F.concat(
                F.array(F.struct(F.lit(True).alias("whole"), F.col("_whole").alias("unit"))),
                F.transform("_lines", lambda l: F.struct(F.lit(False).alias("whole"), l.alias("unit"))),
            )
        ).alias("u"),
    ).select("doc_id", "_row", F.col("u.whole").alias("whole"), digest(F.col("u.unit")).alias("license_digest"))
    hits = units.join(known, "license_digest", "left").filter("whole or license_id is not null")
    line_hit = ~F.col("whole") & F.col("license_id").isNotNull()
    return (
        hits.groupBy("_row", "doc_id")
        .agg(
            F.max(F.when(F.col("whole"), F.col("license_digest"))).alias("text_digest"),
            F.max(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"),
            F.collect_set(F.when(line_hit, F.col("license_id"))).alias("_names"),
            F.count(F.when(line_hit, 1)).alias("n_notices"),
        )
        .select("doc_id", "text_digest", "license_id", F.array_join(F.array_sort("_names"), ",").alias("notices"), "n_notices")
    )
