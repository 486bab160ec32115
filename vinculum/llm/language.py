"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence about a row are combined as log probabilities:

* text: mean log likelihood of its byte trigrams under a model per language (hashed trigram
  counts over all labelled documents, add-one smoothing), tempered by n ** 0.7 because
  overlapping trigrams aren't independent;
* the declared markup language and the language named by the address (country suffix, else
  the first path segment): P(declared | language) and P(address | language), estimated by
  grouped counts of the corpus itself, so an unreliable declaration weighs little;
* a prior per host, smoothed towards its domain, its top level and the whole corpus; a row's
  own text verdict is taken out of its host's counts.

`lang` is the most probable language, or `und` where its posterior is under `least`, or where
the text is long enough to judge and less likely under every model than under a uniform one.

The languages are the four of `LANGUAGES` and every other one that the labelled documents name
in at least `least_rows` rows (`with_labelled`); labels under that count, or that are no
language code, are told in a warning with their rows.

Sizes: the trigram model and the reliability tables have a fixed number of cells and are
collected; host counts grow with the corpus and stay tables, joined on the host.

Defined results: a null or letterless text gives no text evidence; a very long text counts whole,
in numpy passes over slices of texts; rows that repeat an id, or are equal, are judged each for
itself and count each in their host's prior; extra columns are not read; null declarations,
addresses and hosts count as one value `none`; ties go to the earlier language of the list;
an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinculum.llm.common import fresh, over_batches, slices, stage, worker
from vinculum.llm.shingles import text_buffer

LANGUAGES = ("en", "fr", "de", "es")
BUCKETS = 1 << 13

#: What a language label looks like, and codes that name no one language.
LABEL = r"^[a-z]{2,3}([-_][a-z0-9]+)*$"
NO_LANGUAGE = ("und", "mul", "mis", "zxx")

#: The main language of country suffixes that have one.  A language without a
#: model counts as "other" evidence.
SUFFIXES = {
    "ar": "es", "at": "de", "au": "en", "bg": "bg", "bo": "es", "br": "pt", "by": "ru", "cl": "es", "cn": "zh", "co": "es",
    "cr": "es", "cu": "es", "cz": "cs", "de": "de", "dk": "da", "do": "es", "ec": "es", "ee": "et", "es": "es", "fi": "fi",
    "fr": "fr", "gr": "el", "gt": "es", "hk": "zh", "hn": "es", "hr": "hr", "hu": "hu", "id": "id", "ie": "en", "il": "he",
    "ir": "fa", "is": "is", "it": "it", "jp": "ja", "kr": "ko", "lt": "lt", "lv": "lv", "mx": "es", "ni": "es", "nl": "nl",
    "no": "no", "nz": "en", "pa": "es", "pe": "es", "pl": "pl", "pt": "pt", "py": "es", "ro": "ro", "rs": "sr", "ru": "ru",
    "sa": "ar", "se": "sv", "si": "sl", "sk": "sk", "sv": "es", "th": "th", "tr": "tr", "tw": "zh", "ua": "uk", "uk": "en",
    "us": "en", "uy": "es", "ve": "es", "vn": "vi",
}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


@dataclass(frozen=True)
class Params:
    languages: tuple[str, ...] = LANGUAGES
    #: Weight of the level above in a host's, domain's and top level's prior, in rows.
    kappa: float = 5.0
    #: Weight of the overall share in a reliability table, in rows.
    alpha: float = 2.0
    #: Least posterior of a named language.
    least: float = 0.5
    #: From so many trigrams on a text may be told from no language at all.
    judge: int = 12
    #: Labelled rows from which a language beyond `languages` has a model of its own.
    least_rows: int = 50


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts in order, and the n + 1 offsets of each text's trigrams.

    Bytes are lower-cased (A-Z), everything but a-z and bytes from 128 on counts as a space,
    and a trigram counts where its middle byte is a letter.
    """
    buf, offsets = text_buffer(column)
    n = len(buf)
    if n < 3:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    low = _LOWER[buf]
    letter = _LETTER[low]
    code = np.where(letter, low, 32).astype(np.uint32)
    first = code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA77) + code[2:] * np.uint32(0xC2B2AE3D)
    ok = letter[1:-1].copy()
    inner = offsets[1:-1]
    for back in (1, 2):  # none across the border of two texts
        at = inner - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    where = np.flatnonzero(ok)
    mixed = first[where]
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64), np.searchsorted(where, offsets)


@worker("language")
def _counted(batches: Iterator[pa.RecordBatch], languages: Sequence[str]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(len(languages) * BUCKETS, np.int64)
    code = {l: i for i, l in enumerate(languages)}
    for batch in batches:
        langs = np.array([code.get(x, -1) for x in batch.column(0).to_pylist()], np.int64)
        for lo, hi in slices(batch.column(1)):
            found, offsets = trigrams(batch.column(1).slice(lo, hi - lo))
            lang = np.repeat(langs[lo:hi], np.diff(offsets))
            known = lang >= 0
            counts += np.bincount(lang[known] * BUCKETS + found[known], minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["cell", "n"])


def with_labelled(labelled: DataFrame, p: Params = Params()) -> Params:
    """`p` with the further languages that `labelled` (lang) names often enough, sorted by name."""
    label = F.col("lang").cast("string")
    names = labelled.filter(label.isNotNull() & ~label.isin(*p.languages)).groupBy(label.alias("lang")).agg(F.count("*").alias("n"))
    usable = F.col("lang").rlike(LABEL) & ~F.col("lang").isin(*NO_LANGUAGE) & (F.col("n") >= p.least_rows)
    names = stage(names.withColumn("usable", usable), "language-labels")
    more = sorted(r["lang"] for r in names.filter("usable").collect())  # at most rows / least_rows
    left = names.filter("not usable").agg(F.count("*").alias("labels"), F.sum("n").alias("n")).first()
    if left["labels"]:
        some = [f"{r['lang']} ({r['n']})" for r in names.filter("not usable").orderBy(F.desc("n"), "lang").limit(20).collect()]
        warnings.warn(f"no language model from {left['n']} rows of {left['labels']} labels: {', '.join(some)}", stacklevel=2)
    return replace(p, languages=(*p.languages, *more))


def learn(labelled: DataFrame, p: Params = Params()) -> np.ndarray:
    """Log probabilities (language x bucket) from the rows of `labelled` (text, lang) in `p.languages`."""
    rows = over_batches(labelled.select(F.col("lang").cast("string"), F.col("text").cast("string")), partial(_counted, languages=p.languages), "cell long, n long")
    counts = np.ones((len(p.languages), BUCKETS))
    for row in stage(rows.groupBy("cell").agg(F.sum("n").alias("n")), "language-cells").collect():  # at most languages x buckets
        counts[row["cell"] // BUCKETS, row["cell"] % BUCKETS] += row["n"]
    return np.log(counts / counts.sum(axis=1, keepdims=True))


@worker("language")
def _likelihoods(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, the text, by its trigram count and mean log likelihoods."""
    table = np.ascontiguousarray(model.T)
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        for lo, hi in slices(texts, 1 << 18):
            found, offsets = trigrams(texts.slice(lo, hi - lo))
            n = np.diff(offsets)
            means = np.zeros((hi - lo, len(model)))
            full = np.flatnonzero(n)
            if len(full):
                for c in range(len(model)):
                    means[full, c] = np.add.reduceat(table[found, c], offsets[:-1][full]) / n[full]
            ends = pa.array(np.arange(hi - lo + 1, dtype=np.int32) * len(model))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)], pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(ends, pa.array(means.ravel()))],
                names=[*batch.schema.names[:-1], "n", "means"],
            )


def _best(values: list[Column], languages: Sequence[str]) -> Column:
    """The language of the largest value, the earlier one of equals."""
    top = F.greatest(*values)
    return F.coalesce(*[F.when(v == top, F.lit(l)) for v, l in zip(values, languages)])


def _reliability(signals: DataFrame, said: str, p: Params) -> Column:
    """Log P(said | language) as a map from 'language|said'; at most (languages + 2) ** 2 cells."""
    rows = signals.filter("text_lang is not null").groupBy("text_lang", said).count().collect()
    count = {(r["text_lang"], r[said]): r["count"] for r in rows}
    values = [*p.languages, "other", "none"]
    total = sum(count.values())
    entries: list[Column] = []
    for l in p.languages:
        of_l = sum(count.get((l, v), 0) for v in values)
        for v in values:
            overall = (sum(count.get((x, v), 0) for x in p.languages) + 1) / (total + len(values))
            entries += [F.lit(f"{l}|{v}"), F.lit(float(np.log((count.get((l, v), 0) + p.alpha * overall) / (of_l + p.alpha))))]
    return F.create_map(*entries)


def _host_table(signals: DataFrame, p: Params) -> DataFrame:
    """host, one count per language, and the smoothed shares of its domain."""
    langs = p.languages
    counts = [F.sum(F.when(F.col("text_lang") == l, 1).otherwise(0)).alias(f"h_{l}") for l in langs]
    hosts = signals.groupBy("host").agg(*counts).withColumn("domain", F.substring_index("host", ".", -2)).withColumn("top", F.substring_index("host", ".", -1))

    def summed(rows: DataFrame, keys: list[str], old: str, new: str) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(f"{old}_{l}").alias(f"{new}_{l}") for l in langs])

    def total(prefix: str) -> Column:
        return reduce(lambda a, b: a + b, [F.col(f"{prefix}_{l}") for l in langs])

    domains = summed(hosts, ["domain", "top"], "h", "d")
    tops = summed(domains, ["top"], "d", "t")
    whole = tops.agg(*[F.sum(f"t_{l}").alias(l) for l in langs]).first()
    seen = [(whole[l] or 0) + 1 for l in langs]
    for l, n in zip(langs, seen):
        tops = tops.withColumn(f"pt_{l}", (F.col(f"t_{l}") + p.kappa * n / sum(seen)) / (total("t") + p.kappa))
    tops = tops.select("top", *[f"pt_{l}" for l in langs])
    domains = domains.join(tops, "top")
    for l in langs:
        domains = domains.withColumn(f"pd_{l}", (F.col(f"d_{l}") + p.kappa * F.col(f"pt_{l}")) / (total("d") + p.kappa))
    domains = domains.select("domain", "top", *[f"pd_{l}" for l in langs])
    return hosts.join(domains, ["domain", "top"]).select("host", *[f"h_{l}" for l in langs], *[f"pd_{l}" for l in langs])


def identify(rows: DataFrame, model: np.ndarray, p: Params = Params()) -> DataFrame:
    """`rows` (any key columns; host, declared, address, text) without text, with the verdict.

    Adds text_lang (null without text evidence), lang and confidence, the posterior of the best
    language.  host, declared and address come back with nulls as `none`.
    """
    langs = p.languages
    keys = [c for c in rows.columns if c not in ("host", "declared", "address", "text")]

    def said(name: str) -> Column:
        value = F.lower(F.trim(F.col(name).cast("string")))
        return F.when(value.isNull() | (value == ""), "none").when(value.isin(*langs), value).otherwise("other").alias(name)

    host = F.coalesce(F.nullif(F.lower(F.trim(F.col("host").cast("string"))), F.lit("")), F.lit("none")).alias("host")
    slim = rows.select(*keys, host, said("declared"), said("address"), F.col("text").cast("string").alias("text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name != "text")
    signals = over_batches(slim, partial(_likelihoods, model=model), f"{ddl}, n long, means array<double>")
    means = [F.col("means")[i] for i in range(len(langs))]
    signals = stage(signals.withColumn("text_lang", F.when(F.col("n") > 0, _best(means, langs))), "language-signals")

    declared, address = _reliability(signals, "declared", p), _reliability(signals, "address", p)
    hosts = stage(_host_table(signals, p), "language-hosts")
    joined = signals.join(hosts, "host")
    own = [F.when(F.col("text_lang") == l, 1).otherwise(0) for l in langs]
    left = reduce(lambda a, b: a + b, [F.col(f"h_{l}") - o for l, o in zip(langs, own)])
    logs = []
    for i, l in enumerate(langs):
        prior = (F.col(f"h_{l}") - own[i] + p.kappa * F.col(f"pd_{l}")) / (left + p.kappa)
        text = F.when(F.col("n") > 0, F.pow(F.col("n").cast("double"), F.lit(0.7)) * means[i]).otherwise(F.lit(0.0))
        logs.append(text + declared[F.concat(F.lit(f"{l}|"), F.col("declared"))] + address[F.concat(F.lit(f"{l}|"), F.col("address"))] + F.log(prior))
    joined = joined.select("*", *[x.alias(f"log_{l}") for x, l in zip(logs, langs)])
    found = [F.col(f"log_{l}") for l in langs]
    joined = joined.withColumn("_top", F.greatest(*found)).withColumn("_best", _best(found, langs))
    joined = joined.withColumn("confidence", 1 / reduce(lambda a, b: a + b, [F.exp(x - F.col("_top")) for x in found]))
    strange = (F.col("n") >= p.judge) & (F.greatest(*means) < float(-np.log(BUCKETS)))
    lang = F.when(strange | (F.col("confidence") < p.least), "und").otherwise(F.col("_best"))
    return joined.select(*keys, "host", "declared", "address", "text_lang", lang.alias("lang"), "confidence", "n")


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, host, declared, address, text of raw pages (page_id, url, html)."""
    url, html = F.col("url").cast("string"), F.col("html").cast("string")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    suffix = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])[F.substring_index(host, ".", -1)]
    segment = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/([A-Za-z]{2})(?:[-_/.?#]|$)", 1))
    declared = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    body = F.regexp_replace(html, r"(?is)<(script|style|nav|head)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), declared.alias("declared"), F.coalesce(suffix, segment).alias("address"), body.alias("text"))


def document_rows(docs: DataFrame) -> DataFrame:
    """doc_id, host, declared, address, text of documents: the source stands for the host, the
    lang column for the declaration; there is no address."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("host"),
        F.col("lang").cast("string").alias("declared"),
        F.lit(None).cast("string").alias("address"),
        F.col("text").cast("string").alias("text"),
    )


def keep_identified(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of `docs` in one of the languages, with their columns; `und` rows go.

    Verdicts are looked up by doc_id and the SHA-256 of text, lang and source, so rows that
    repeat a doc_id with another text keep verdicts of their own.
    """
    id_, name = fresh(docs, "_language_id"), fresh(docs, "_language_key")

    def key(*values: Column) -> Column:  # sizes first: no two lists of values run together
        texts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
        return F.sha2(F.concat(*texts), 256)

    whole = key(*[F.col(c).cast("string") for c in ("text", "lang", "source")])
    doc_id = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    p = with_labelled(docs, p)
    model = learn(docs, p)
    rows = document_rows(docs.select("doc_id", "text", "lang", "source")).withColumns({id_: doc_id, name: key(F.col("text"), F.col("declared"), F.col("host"))})
    gone = stage(identify(rows, model, p).filter("lang = 'und'").select(id_, name).distinct(), "language-gone")
    return docs.withColumns({id_: doc_id, name: whole}).join(gone, [id_, name], "left_anti").drop(id_, name)
