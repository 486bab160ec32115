from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.samples import documents, edge_rows
from vinculum.llm import language
from vinculum.llm.language import Params

#: Letter sets that stand for languages.
ALPHABETS = {"en": "thewionrs", "fr": "leuxéaquo", "de": "schunßgei", "es": "ñdoselaió"}


def said(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choices(ALPHABETS[lang], k=rng.randint(2, 7))) for _ in range(n))


def corpus(spark, rng, n=60):
    return documents(spark, [(i, said(rng, lang, 40), lang, "s") for i, lang in enumerate(list(ALPHABETS) * n)])


def brute_force(rows, model, p: Params):
    """The documented formulas, row by row."""
    langs = p.languages
    clean = lambda v: "none" if not (v or "").strip() else v.strip().lower() if v.strip().lower() in langs else "other"
    seen = []
    for key, host, declared, address, text in rows:
        found, _ = language.trigrams(pa.array([text or ""]))
        n = len(found)
        means = model[:, found].mean(axis=1) if n else np.zeros(len(langs))
        seen.append((key, (host or "").strip().lower() or "none", clean(declared), clean(address), n, means, langs[int(np.argmax(means))] if n else None))

    def table(col):
        values = [*langs, "other", "none"]
        count = lambda l, v: sum(1 for s in seen if s[6] == l and s[col] == v)
        total = sum(1 for s in seen if s[6])
        out = {}
        for l in langs:
            of_l = sum(count(l, v) for v in values)
            for v in values:
                overall = (sum(count(x, v) for x in langs) + 1) / (total + len(values))
                out[l, v] = math.log((count(l, v) + p.alpha * overall) / (of_l + p.alpha))
        return out

    declared, address = table(2), table(3)
    domain = lambda h: ".".join(h.split(".")[-2:])
    top = lambda h: h.split(".")[-1]
    tally = lambda level, value, l: sum(1 for s in seen if s[6] == l and level(s[1]) == value)
    whole = {l: sum(1 for s in seen if s[6] == l) + 1 for l in langs}
    out = {}
    for key, host, d, a, n, means, own in seen:
        logs = []
        for i, l in enumerate(langs):
            tops = {x: tally(top, top(host), x) for x in langs}
            pt = (tops[l] + p.kappa * whole[l] / sum(whole.values())) / (sum(tops.values()) + p.kappa)
            doms = {x: tally(domain, domain(host), x) for x in langs}
            pd = (doms[l] + p.kappa * pt) / (sum(doms.values()) + p.kappa)
            hosts = {x: tally(lambda h: h, host, x) - (x == own) for x in langs}
            prior = (hosts[l] + p.kappa * pd) / (sum(hosts.values()) + p.kappa)
            logs.append((n**0.7 * means[i] if n else 0.0) + declared[l, d] + address[l, a] + math.log(prior))
        best = int(np.argmax(logs))
        confidence = 1 / sum(math.exp(x - logs[best]) for x in logs)
        strange = n >= p.judge and means.max() < -math.log(language.BUCKETS)
        out[key] = ("und" if strange or confidence < p.least else langs[best], confidence, own)
    return out


def test_fusion_equals_brute_force(spark):
    rng = random.Random(1)
    model = language.learn(corpus(spark, rng))
    hosts = ["a.x.com", "b.x.com", "y.fr", "deep.er.y.fr", None, "", "hot.example.de"]
    rows = []
    for i in range(120):
        lang = rng.choice(list(ALPHABETS))
        text = rng.choice([said(rng, lang, rng.randint(1, 30)), "", None, "12345 67890 !!", "zzkk " * 30])
        host = "hot.example.de" if i % 3 == 0 else rng.choice(hosts)
        rows.append((i, host, rng.choice([lang, lang, lang, "xx", None, " FR "]), rng.choice([lang, None, ""]), text))
    frame = spark.createDataFrame(rows, "page_id long, host string, declared string, address string, text string").repartition(4)
    got = {r["page_id"]: r for r in language.identify(frame, model).collect()}
    expected = brute_force(rows, model, Params())
    assert set(got) == set(expected)
    for key, (lang, confidence, own) in expected.items():
        assert (got[key]["lang"], got[key]["text_lang"]) == (lang, own)
        assert got[key]["confidence"] == pytest.approx(confidence, rel=1e-9)
    assert {"und", *ALPHABETS} >= {v[0] for v in expected.values()} and "und" in {v[0] for v in expected.values()}


def test_model_counts_every_document(spark):
    rng = random.Random(2)
    docs = corpus(spark, rng, 5)
    model = language.learn(docs.repartition(3))
    counts = np.ones((4, language.BUCKETS))
    for r in docs.collect():
        found, _ = language.trigrams(pa.array([r["text"]]))
        np.add.at(counts[list(ALPHABETS).index(r["lang"])], found, 1)
    assert np.allclose(model, np.log(counts / counts.sum(axis=1, keepdims=True)))


def test_languages_come_from_the_labels(spark):
    """A fifth label with enough rows is a language; a rare one and junk are told."""
    rng = random.Random(9)
    italian = ["".join(rng.choices("zpbmvazy", k=300)) for _ in range(60)]
    more = [(1000 + i, t, "it", "s") for i, t in enumerate(italian)] + [(2000, "zz kk", "nl", "s"), (2001, "zz", "No code", "s"), (2002, "x", None, "s")]
    docs = corpus(spark, rng).unionByName(documents(spark, more))
    with pytest.warns(UserWarning, match=r"2 rows of 2 labels: No code \(1\), nl \(1\)"):
        p = language.with_labelled(docs)
    assert p.languages == ("en", "fr", "de", "es", "it")
    rows = spark.createDataFrame([(i, "h.x", None, None, t) for i, t in enumerate(italian)], "id long, host string, declared string, address string, text string")
    assert {r["lang"] for r in language.identify(rows, language.learn(docs, p), p).collect()} == {"it"}
    with pytest.warns(UserWarning):
        kept = language.keep_identified(docs)
    assert kept.filter("lang = 'it'").count() == 60


def test_trigrams_stay_inside_texts():
    texts = ["abc", "", None, "a", "Éa bcd", "XYZ"]
    found, offsets = language.trigrams(pa.array(texts))
    for i, text in enumerate(texts):
        alone, _ = language.trigrams(pa.array([text or ""]))
        assert found[offsets[i] : offsets[i + 1]].tolist() == alone.tolist()


def test_pages(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://u@WWW.Site.fr:80/en/x?y", '<!doctype html><HTML class="a" lang=fr-CA><head><title>no</title></head><body><script>var x</script><nav>nav</nav><p>ça &amp; là</p><!-- no --></body>'),
            (2, "http://h.example.com/de/7", "<html lang='DE'>"),
            (3, "not a url", None),
            (4, None, "text only"),
        ],
        "page_id long, url string, html string",
    )
    got = {r["page_id"]: r for r in language.page_rows(pages).collect()}
    assert (got[1]["host"], got[1]["declared"], got[1]["address"], got[1]["text"].split()) == ("www.site.fr", "fr", "fr", ["ça", "là"])
    assert (got[2]["host"], got[2]["declared"], got[2]["address"]) == ("h.example.com", "DE", "de")
    assert (got[3]["host"], got[3]["address"], got[3]["text"]) == ("", "", None)
    assert got[4]["host"] is None and got[4]["text"] == "text only"


def test_keep_identified(spark):
    rng = random.Random(4)
    base = corpus(spark, rng, 30)
    odd = documents(spark, [r for r in edge_rows(rng) if r[0] not in (8, 9)] + [(500, "kkzz " * 60, "xx", "s1"), (501, said(rng, "fr", 30), "en", "s1"), (500, said(rng, "de", 30), "de", None)])
    docs = base.unionByName(odd)
    out = language.keep_identified(docs)
    assert out.schema == docs.schema
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert {(r["doc_id"], r["text"]) for r in base.collect()} <= set(kept)
    assert 501 in {i for i, _ in kept}
    assert [t for i, t in kept if i == 500] == [r["text"] for r in odd.filter("doc_id = 500 and lang = 'de'").collect()]
    assert language.keep_identified(docs.limit(0)).count() == 0


def test_suffix_of_a_learned_language(spark):
    pages = spark.createDataFrame([(1, "http://a.it/", "<p>x"), (2, "http://a.ch/de/x", "<p>x"), (3, "http://a.com/", "<p>x")], "page_id long, url string, html string")
    assert {r["page_id"]: r["address"] or None for r in language.page_rows(pages).collect()} == {1: "it", 2: "de", 3: None}
    texts = [f"{'il gatto nero dorme' if i % 2 else 'the black cat sleeps'} {i}" for i in range(120)]
    labelled = spark.createDataFrame([("it" if i % 2 else "en", t) for i, t in enumerate(texts)], "lang string, text string")
    p = language.with_labelled(labelled)
    rows = spark.createDataFrame([(i, f"h{i}.x", None, "it" if i % 2 else "en", t) for i, t in enumerate(texts)] + [(1000, "none.it", None, "it", None), (1001, "none.uk", None, "en", None)],
                                 "id long, host string, declared string, address string, text string")
    got = {r["id"]: r["lang"] for r in language.identify(rows, language.learn(labelled, p), p).collect()}
    assert (got[1000], got[1001]) == ("it", "en")  # told by the suffix alone
