"""Tier 1: alias lookup (J4), candidate search (J1-J3) and the decision table.

Design (set-based, no per-row lookups):

1. Pending rows outside the catalog categories are settled at once (C1), before any join.
2. The rest are reduced to distinct *signatures* ``(words, producer_key, category, size_ml)``,
   ``words`` being the name's tokens in order; many submissions share one, so a hot product
   costs one row, not a third of the input.
3. Candidate search is a set-containment join: a product is a candidate when the signature's
   name tokens are a subset of the product's tokens.  It runs between distinct token sets of a
   block: those asked for, whatever the size, and those that products have, each with its number
   of products per size; products or submissions of the same words add nothing to it.
   Containment implies that a set holds the *rarest* token asked for (rarest among the block's
   sets), so the join is an equi-join on ``(producer_key, category, token)`` against the exploded
   sets, with the subset test as a residual predicate.
4. Where even the rarest token is *dense* (in more than ``DENSE`` token sets of its block), the
   search goes by the two rarest tokens together.  Where these too are in more sets, no pair
   is written: products have ordinals in catalog order, every dense token a bitmap of them per
   32,768 ordinals, and the counts are those of the bits that the bitmaps of all tokens (and of
   the size) have in common.
5. A signature without tokens (a name with no letters or digits) is a subset of every product
   of its block; its counts come from per-block aggregates, without pairs.
6. Per signature: ``n_at_size`` (same size), ``n_any`` and the same-size product (when unique).
   The decision table is one CASE over these and the row's vintage.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculum import schemas as S
from vinculum.functions.text import alias_key, normalize, producer_key, tokens
from vinculum.operators.joins import reshuffled
from vinculum.session import scratch_path

SIG = ["words", "producer_key", "category", "size_ml"]
#: A token set asked for in a block, whatever the size.
ASKED = ["words", "producer_key", "category"]
#: Order of the catalog's ordinals: a block, and in it a size, is a range of them.
ORDER = ["producer_key", "category", "size_ml", "product_id"]
#: A token in more token sets of a block than this has bitmaps there (4 KB for 32,768 ordinals).
DENSE = 256


def prepare_aliases(aliases: DataFrame) -> DataFrame:
    """One canonical producer per alias key (dictionary semantics)."""
    return aliases.select(alias_key(F.col("alias")).alias("alias_key"), "canonical").groupBy("alias_key").agg(
        F.min("canonical").alias("canonical")
    )


def with_producer_key(df: DataFrame, aliases: DataFrame) -> DataFrame:
    """``producer_key = lower(alias.canonical or submitted producer)``."""
    a = reshuffled(prepare_aliases(aliases), "alias_key")
    j = df.join(a, alias_key(df["producer"]) == a["alias_key"], "left")
    return j.withColumn("producer_key", producer_key(F.coalesce(F.col("canonical"), F.col("producer")))).drop(
        "alias_key", "canonical"
    )


def prepare_catalog(catalog: DataFrame) -> DataFrame:
    """Catalog with its lookup key and name tokens computed once."""
    return catalog.select(
        "product_id",
        "canonical_name",
        "producer",
        "category",
        "size_ml",
        F.coalesce(F.col("vintage_required"), F.lit(False)).alias("vintage_required"),
        producer_key(F.col("producer")).alias("producer_key"),
        tokens(normalize(F.col("canonical_name"))).alias("p_tokens"),
    )


@dataclass
class CatalogIndex:
    """Catalog-side inputs of the candidate search, built once per catalog version.

    ``cat``: products with ``producer_key``, ``p_tokens`` and their ordinal ``ord`` (from 1) in
    the order of ``ORDER``; ``ctok``: one row per (token set of a block, token), the set with
    ``sizes``: products per size, and the first one's ordinal; ``freq``: token sets per
    (producer_key, category, token) and whether that is ``dense``; ``postings``: bitmaps of the
    ordinals of each dense token, None where no token is dense; ``at_size`` / ``any_size``: block
    counts for signatures without tokens; ``few``: two dense tokens that meet in up to so many
    token sets of a block are looked up together, others by bitmaps.
    """

    cat: DataFrame
    ctok: DataFrame
    freq: DataFrame
    postings: DataFrame | None
    at_size: DataFrame
    any_size: DataFrame
    few: int = DENSE


def build_index(catalog: DataFrame, path: str | None = None, *, dense: int = DENSE) -> CatalogIndex:
    """The catalog index, written under ``path`` and read back: build it once per catalog version
    and hand :func:`read_index` to every import and stream.  Without ``path`` it is a stage table
    of this process.  ``dense`` changes where bitmaps replace pairs, never a result."""
    spark = catalog.sparkSession
    path = path or scratch_path(spark, f"index-{uuid.uuid4().hex}")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    # ordinals are what the written table says; nothing computes them a second time
    ordered = prepare_catalog(catalog).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER, "vintage_required")
    cat = written(ordered.withColumn("ord", F.monotonically_increasing_id() + 1), "cat")
    ctok = written(_catalog_tokens(cat), "ctok")
    freq = written(_frequencies(ctok, dense), "freq")
    holders = cat.select("producer_key", "category", "ord", F.explode("p_tokens").alias("token"))
    written(_bitmaps(holders.join(freq.filter("dense"), BLOCK_TOKEN, "left_semi"), BLOCK_TOKEN), "postings")
    return replace(read_index(spark, path), few=dense)


def read_index(spark: SparkSession, path: str) -> CatalogIndex:
    """An index that :func:`build_index` wrote."""
    cat, ctok, freq, postings = (spark.read.parquet(f"{path}/{name}") for name in ("cat", "ctok", "freq", "postings"))
    # the two per-block counts are small aggregates of the catalog and stay lazy
    return CatalogIndex(
        cat=cat,
        ctok=ctok,
        freq=freq,
        postings=None if postings.isEmpty() else postings,  # spares small catalogs the branch
        at_size=cat.groupBy("producer_key", "category", "size_ml").agg(
            F.count(F.lit(1)).alias("n_at_size"),
            F.min(F.struct("product_id", "vintage_required")).alias("first_at"),
        ),
        any_size=cat.groupBy("producer_key", "category").agg(F.count(F.lit(1)).alias("n_any")),
    )


BLOCK_TOKEN = ["token", "producer_key", "category"]
#: The two rarest tokens asked for in a block, the rarer first.
BLOCK_PAIR = [*BLOCK_TOKEN, "second"]


def _frequencies(ctok: DataFrame, dense: int) -> DataFrame:
    return ctok.groupBy(*BLOCK_TOKEN).agg(F.count(F.lit(1)).alias("df")).withColumn("dense", F.col("df") > dense)


def _bitmaps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., bucket, bits): the ordinals of ``rows`` as bitmaps, built map-side first."""
    return rows.groupBy(*keys, F.bitmap_bucket_number("ord").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("ord")).alias("bits")
    )


def _first_ordinal(bucket: Column, bits: Column) -> Column:
    """The least ordinal of a bitmap that has one."""
    digits = F.hex(bits)
    byte = F.floor((F.length(digits) - F.length(F.ltrim(digits, F.lit("0")))) / 2)
    value = F.conv(F.substring(digits, (2 * byte + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
    bit = F.log2(value.bitwiseAND(-value)).cast("int")
    return (bucket - 1) * 32768 + 8 * byte + bit + 1


def _written(df: DataFrame, name: str) -> DataFrame:
    """A table of the search, written once for the plans that read it."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _index(catalog: DataFrame | CatalogIndex) -> CatalogIndex:
    return catalog if isinstance(catalog, CatalogIndex) else build_index(catalog)


def _words(name_tokens: Column) -> Column:
    """A token set as text: equal for equal sets."""
    return F.array_join(F.array_sort(name_tokens), " ")


def _catalog_tokens(cat: DataFrame) -> DataFrame:
    keyed = cat.withColumn("held", _words(F.col("p_tokens")))
    sized = keyed.groupBy("producer_key", "category", "held", "size_ml").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("ord"))
    sets = sized.groupBy("producer_key", "category", "held").agg(F.collect_list(F.struct("size_ml", "n", "ord")).alias("sizes"))
    return sets.withColumn("p_tokens", tokens(F.col("held"))).select("*", F.explode("p_tokens").alias("token"))


def _chosen(asked: DataFrame, idx: CatalogIndex) -> DataFrame:
    """(ASKED..., token, dense, second, s_tokens): the rarest token of the sets whose tokens are
    all known in their block, whether it is dense, and the next rarest (null where it is the only one)."""
    stok = asked.filter(F.col("words") != "").select(*ASKED, F.explode(tokens(F.col("words"))).alias("token"))
    found = stok.join(reshuffled(idx.freq, "token"), BLOCK_TOKEN, "inner")
    # one aggregate gives the rarest tokens and whether the block knows all of them
    return (
        found.groupBy(*ASKED)
        .agg(F.array_sort(F.collect_list(F.struct("df", "token", "dense"))).alias("ranked"))
        .withColumn("s_tokens", tokens(F.col("words")))
        .filter(F.size("ranked") == F.size("s_tokens"))
        .withColumn("rarest", F.col("ranked")[0])
        .select(*ASKED, "rarest.token", "rarest.dense", F.try_element_at("ranked", F.lit(2))["token"].alias("second"), "s_tokens")
    )


def _found_sets(chosen: DataFrame, holders: DataFrame, key: list[str]) -> DataFrame:
    """(ASKED..., held, sizes): the products' token sets that hold all tokens asked for, among
    ``holders``, the sets per ``key``."""
    pairs = chosen.join(holders, key, "inner").filter(F.size(F.array_except("s_tokens", "p_tokens")) == 0)
    return pairs.select(*ASKED, "held", "sizes")


def _pair_holders(chosen: DataFrame, ctok: DataFrame) -> DataFrame:
    """``ctok`` per BLOCK_PAIR asked for instead of per token.

    A pair's tokens are both dense, so the seconds of a token are a few of its block's.
    """
    seconds = chosen.groupBy(*BLOCK_TOKEN).agg(F.collect_set("second").alias("seconds"))
    met = ctok.join(reshuffled(seconds, "token"), BLOCK_TOKEN)
    return met.withColumn("second", F.explode(F.array_intersect("p_tokens", "seconds"))).drop("seconds")


def _pair_counts(chosen: DataFrame, idx: CatalogIndex) -> DataFrame:
    """Dense ``chosen`` rows with ``n_both``, the sets that hold their two rarest tokens; null
    where there is no second.  Rows whose tokens never meet have no candidates and are left out."""
    paired = chosen.filter(F.col("second").isNotNull())
    held = _pair_holders(paired, idx.ctok.select(*BLOCK_TOKEN, "p_tokens"))
    both = held.groupBy(*BLOCK_PAIR).agg(F.count(F.lit(1)).alias("n_both"))
    alone = chosen.filter(F.col("second").isNull())
    return paired.join(reshuffled(both, "token"), BLOCK_PAIR).unionByName(alone.withColumn("n_both", F.lit(None).cast("long")))


def candidate_pairs(asked: DataFrame, idx: CatalogIndex) -> DataFrame:
    """J1+J2 for token sets (ASKED): (ASKED..., product_id, p_size, vintage_required)."""
    products = idx.cat.select(
        "producer_key", "category", _words(F.col("p_tokens")).alias("held"), "product_id", F.col("size_ml").alias("p_size"), "vintage_required"
    )
    found = _found_sets(_chosen(asked, idx), idx.ctok, BLOCK_TOKEN).drop("sizes")
    return found.join(products, ["producer_key", "category", "held"]).select(*ASKED, "product_id", "p_size", "vintage_required")


def _dense_counts(chosen: DataFrame, sigs: DataFrame, idx: CatalogIndex) -> DataFrame:
    """Counts by bitmaps, for signatures whose tokens are all dense.

    A set asked for brings one row per token and bucket of its block, however many products hold
    the token, and a signature one per bucket of its size.  Ordinals ascend by product id within
    a size, so the first bit is the first product.
    """
    stok = chosen.select(*ASKED, F.explode("s_tokens").alias("token"))
    met = (
        stok.join(idx.postings, BLOCK_TOKEN)
        .groupBy(*ASKED, "bucket")
        .agg(F.count(F.lit(1)).alias("n_met"), F.bitmap_and_agg("bits").alias("bits"))
        .filter((F.col("n_met") == F.size(tokens(F.col("words")))) & (F.bitmap_count("bits") > 0))
        .select(*ASKED, "bucket", "bits")
    )
    anywhere = met.groupBy(*ASKED).agg(F.sum(F.bitmap_count("bits")).alias("n_any"))
    size = ["producer_key", "category", "size_ml"]
    wanted = sigs.join(reshuffled(chosen.select(*ASKED), "words"), ASKED, "left_semi")
    asked_sizes = reshuffled(wanted.select(*size).distinct(), "producer_key")
    of_size = _bitmaps(idx.cat.join(asked_sizes, size, "left_semi"), size).withColumnRenamed("bits", "size_bits")
    at = (
        wanted.join(reshuffled(met, "words"), ASKED)
        .join(reshuffled(of_size, "producer_key"), [*size, "bucket"])
        .select(*SIG, "bucket", F.explode(F.array("bits", "size_bits")).alias("bits"))
        .groupBy(*SIG, "bucket")
        .agg(F.bitmap_and_agg("bits").alias("bits"))
        .filter(F.bitmap_count("bits") > 0)
        .groupBy(*SIG)
        .agg(F.sum(F.bitmap_count("bits")).alias("n_at_size"), F.min(_first_ordinal(F.col("bucket"), F.col("bits"))).alias("ord"))
    )
    both = wanted.join(reshuffled(anywhere, "words"), ASKED).join(reshuffled(at, "words"), SIG, "left")
    return both.select(*SIG, F.coalesce("n_at_size", F.lit(0)).alias("n_at_size"), "n_any", "ord")


def _set_counts(found_sets: DataFrame, sigs: DataFrame) -> DataFrame:
    """Counts among token sets: per set asked for one row with the products of each size."""
    of_size = (
        found_sets.select(*ASKED, F.explode("sizes").alias("s"))
        .groupBy(*ASKED, F.col("s.size_ml").alias("p_size"))
        .agg(F.sum("s.n").alias("n"), F.min("s.ord").alias("ord"))
    )
    found = of_size.groupBy(*ASKED).agg(F.sum("n").alias("n_any"), F.collect_list(F.struct("p_size", "n", "ord")).alias("sizes"))
    at = F.try_element_at(F.filter("sizes", lambda s: s["p_size"] == F.col("size_ml")), F.lit(1))
    counted = sigs.join(reshuffled(found, "words"), ASKED).withColumn("at", at)
    return counted.select(*SIG, F.coalesce("at.n", F.lit(0)).alias("n_at_size"), "n_any", "at.ord")


def _block_counts(sigs: DataFrame, idx: CatalogIndex) -> DataFrame:
    """Counts for signatures without tokens: every product of the block is a candidate."""
    empty = sigs.filter(F.col("words") == "")
    return (
        empty.join(idx.at_size, ["producer_key", "category", "size_ml"], "left")
        .join(idx.any_size, ["producer_key", "category"], "left")
        .select(*SIG, "n_at_size", "n_any", "first_at")
    )


def _signature_counts(sigs: DataFrame, idx: CatalogIndex) -> DataFrame:
    """(SIG..., n_at_size, n_any, first_at) for distinct signatures."""
    chosen = _chosen(sigs.select(*ASKED).distinct(), idx)
    if idx.postings is None:
        counted = _set_counts(_found_sets(chosen, idx.ctok, BLOCK_TOKEN), sigs)
    else:
        chosen = _written(chosen, "chosen")  # each step of the search reads it
        found, dense = _found_sets(chosen.filter(~F.col("dense")), idx.ctok, BLOCK_TOKEN), chosen.filter("dense")
        if idx.few and not dense.isEmpty():
            paired = _written(_pair_counts(dense, idx), "pairs")
            few, dense = paired.filter(F.col("n_both") <= idx.few), paired.filter(F.col("n_both").isNull() | (F.col("n_both") > idx.few))
            if not few.isEmpty():
                found = found.unionByName(_found_sets(few, _pair_holders(few, idx.ctok), BLOCK_PAIR))
        counted = _set_counts(found, sigs)
        if not dense.isEmpty():
            counted = counted.unionByName(_dense_counts(dense, sigs, idx))
    products = idx.cat.select("ord", F.struct("product_id", "vintage_required").alias("first_at"))
    tok = counted.join(products, "ord", "left").select(*SIG, "n_at_size", "n_any", "first_at")
    return tok.unionByName(_block_counts(sigs, idx))


def candidate_counts(sigs: DataFrame, idx: CatalogIndex) -> DataFrame:
    """Per (producer_key, category, size_ml, norm), candidates at the same size, at any size,
    and the first same-size one."""
    keyed = sigs.withColumn("words", _words(tokens(F.col("norm"))))
    counts = _signature_counts(keyed.select(*SIG).distinct(), idx)
    named = ["producer_key", "category", "size_ml", "norm"]
    return keyed.join(reshuffled(counts, "words"), SIG).select(*named, "n_at_size", "n_any", "first_at")


def pending_signatures(state: DataFrame, aliases: DataFrame) -> DataFrame:
    """Pending rows with their signature columns and the C1 scope flag."""
    pend = state.filter(F.col("status") == "pending")
    p = with_producer_key(pend, aliases)
    return p.withColumn("words", _words(tokens(normalize(F.col("name"))))).withColumn(
        "in_scope", F.col("category").isin(*S.CATEGORIES)
    )


def classify(n_at: Column, n_any: Column, first_at: Column, vintage: Column, in_scope: Column) -> dict[str, Column]:
    """C1-C6 in order; returns status, decision, matched_product_id, explanation."""
    n_at = F.coalesce(n_at, F.lit(0))
    n_any = F.coalesce(n_any, F.lit(0))
    vreq = F.coalesce(first_at.getField("vintage_required"), F.lit(False))
    c1 = ~in_scope
    c2 = (n_at == 1) & vreq & vintage.isNull()
    c3 = n_at == 1
    c4 = n_at > 1
    c5 = n_any == 1

    def case(v1, v2, v3, v4, v5, v6):
        return F.when(c1, v1).when(c2, v2).when(c3, v3).when(c4, v4).when(c5, v5).otherwise(v6)

    null = F.lit(None).cast("string")
    pid = first_at.getField("product_id")
    return {
        "status": case(F.lit("no_match"), F.lit("review"), F.lit("matched"), F.lit("review"), F.lit("no_match"), F.lit("unmatched")),
        "decision": case(
            F.lit("no_match"), F.lit("human_review"), F.lit("exact_match"), F.lit("human_review"), F.lit("no_match"), null
        ),
        "matched_product_id": case(null, pid, pid, null, null, null),
        "explanation": case(
            F.lit(S.CATEGORY_MISMATCH),
            F.lit(S.VINTAGE_REQUIRED_MISSING),
            null,
            F.lit(S.MULTIPLE_CANDIDATES),
            F.lit(S.SIZE_ML_MISMATCH),
            null,
        ),
    }


def tier1_outcomes(
    state: DataFrame,
    catalog: DataFrame | CatalogIndex,
    aliases: DataFrame,
    *,
    require_tokens: bool = False,
    pending: DataFrame | None = None,
) -> DataFrame:
    """Pending rows with ``n_at_size, n_any, first_at, in_scope`` (the J1-J3 verdict per row).

    ``catalog`` is the catalog or a prebuilt :class:`CatalogIndex`.  A name without letters
    or digits has no tokens and is a subset of every product of its block (H3, the default
    semantics); ``require_tokens=True`` gives such names no candidates instead.  ``pending``:
    :func:`pending_signatures` of the state, written once, since the plan reads it three times.
    """
    p = pending_signatures(state, aliases) if pending is None else pending
    idx = _index(catalog)
    inside = p.filter(F.col("in_scope"))
    outside = p.filter(~F.col("in_scope"))
    sigs = inside.select(*SIG).distinct()
    if require_tokens:
        sigs = sigs.filter(F.col("words") != "")
    counts = _signature_counts(sigs, idx)
    j = inside.join(reshuffled(counts, "words"), SIG, "left")
    none = outside.select(
        *outside.columns,
        F.lit(None).cast("long").alias("n_at_size"),
        F.lit(None).cast("long").alias("n_any"),
        F.lit(None).cast("struct<product_id:string,vintage_required:boolean>").alias("first_at"),
    )
    return j.unionByName(none)


def match_tier1(
    state: DataFrame,
    catalog: DataFrame | CatalogIndex,
    aliases: DataFrame,
    run_ts: _dt.datetime,
    *,
    require_tokens: bool = False,
    pending: DataFrame | None = None,
) -> DataFrame:
    """Pending -> matched / review / no_match / unmatched; other rows pass through."""
    is_pend = F.col("status") == "pending"
    rest = state.filter(~is_pend | is_pend.isNull())
    o = tier1_outcomes(state, catalog, aliases, require_tokens=require_tokens, pending=pending)
    c = classify(F.col("n_at_size"), F.col("n_any"), F.col("first_at"), F.col("vintage"), F.col("in_scope"))
    out = (
        o.withColumn("status", c["status"])
        .withColumn("decision", c["decision"])
        .withColumn("matched_product_id", c["matched_product_id"])
        .withColumn("explanation", c["explanation"])
        .withColumn("tier1_status", F.col("status"))
        .withColumn("updated_at", F.lit(run_ts).cast("timestamp"))
    )
    return rest.unionByName(out.select(*state.columns))


def match_summary(state: DataFrame) -> DataFrame:
    """exact_matches, human_reviews, no_matches, unmatched (from the tier-1 audit column)."""
    t = F.col("tier1_status")
    return state.agg(
        F.count_if(t == "matched").alias("exact_matches"),
        F.count_if(t == "review").alias("human_reviews"),
        F.count_if(t == "no_match").alias("no_matches"),
        F.count_if(t == "unmatched").alias("unmatched"),
    )


def catalog_find(
    catalog: DataFrame, producer: str | None = None, category: str | None = None, size_ml: int | None = None
) -> DataFrame:
    """optional-predicate catalog lookup (each predicate applies only when given).

    A stored catalog (:func:`vinculum.sources.store.write_catalog`) has the lower-cased producer
    as a column, so all predicates are pushed down to its row groups.
    """
    df = catalog
    if producer is not None:
        key = F.col("producer_key") if "producer_key" in catalog.columns else producer_key(F.col("producer"))
        df = df.filter(key == producer_key(F.lit(producer)))
    if category is not None:
        df = df.filter(F.col("category") == F.lit(category))
    if size_ml is not None:
        df = df.filter(F.col("size_ml") == F.lit(size_ml))
    return df.select("product_id", "canonical_name", "producer", "category", "size_ml", "vintage_required")


def row_candidate_pairs(
    state: DataFrame, catalog: DataFrame | CatalogIndex, aliases: DataFrame, *, pending: DataFrame | None = None
) -> DataFrame:
    """J1+J2 per pending row whose name has tokens: ``(submission_id, product_id, at_size)``.

    A name without letters or digits stands for every product of its block; that is a count per
    block (:func:`candidate_counts`), and its pairs are never written.  ``pending`` as for
    :func:`tier1_outcomes`.
    """
    p = pending_signatures(state, aliases) if pending is None else pending
    p = p.filter(F.col("in_scope") & (F.col("words") != ""))
    pairs = candidate_pairs(p.select(*ASKED).distinct(), _index(catalog))
    return p.select("submission_id", *SIG).join(reshuffled(pairs, "words"), ASKED).select(
        "submission_id", "product_id", (F.col("p_size") == F.col("size_ml")).alias("at_size")
    )
