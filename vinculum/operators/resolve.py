"""Tier 2: decision cache (J5, L7), pluggable resolver (L2), decision checks (L3) and the
application rules (L4, L5, L6, U3), plus the request table (L1) and the summary (A8).

A resolver is any ``DataFrame -> DataFrame`` that adds ``llm_output`` (the model's answer
as JSON text) and ``llm_error`` (``"Type: message"`` when there is no answer) to the rows it
is given.  Two are provided: a decisions table joined by fingerprint, and a Python function
run over Arrow batches (the only Python on this data path).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinculum import schemas as S
from vinculum.functions.text import first_or_null, normalize, tokens
from vinculum.operators.joins import never_broadcast, reshuffled
from vinculum.operators.match import with_producer_key
from vinculum.session import share_package

Resolver = Callable[[DataFrame], DataFrame]


def decision_cache(history: DataFrame, model_id: str, prompt_version: str = S.PROMPT_VERSION) -> DataFrame:
    """Per fingerprint, the oldest stored answer of this model and prompt version.

    Only rows with output count; ties on ``updated_at`` go to the smaller submission_id (H12).
    """
    h = history.filter(
        F.col("llm_output").isNotNull()
        & (F.col("llm_model") == model_id)
        & (F.col("llm_prompt_version") == prompt_version)
        & F.col("fingerprint").isNotNull()
    )
    return h.groupBy("fingerprint").agg(
        F.min_by("llm_output", F.struct("updated_at", "submission_id")).alias("cached_output")
    )


CACHE_KEYS = ["llm_model", "llm_prompt_version", "fingerprint"]


def cache_entries(state: DataFrame, *carried: str) -> DataFrame:
    """Cache rows ``(llm_model, llm_prompt_version, fingerprint, llm_output, updated_at)`` from
    the answered rows of ``state``: the oldest answer per key (ties: smaller submission_id),
    with its row's columns ``carried``."""
    h = state.filter(F.col("llm_output").isNotNull() & F.col("fingerprint").isNotNull() & F.col("llm_model").isNotNull())
    return h.groupBy(*CACHE_KEYS).agg(
        F.min_by(F.struct("llm_output", "updated_at", *carried), F.struct("updated_at", "submission_id")).alias("a")
    ).select(*CACHE_KEYS, "a.*")


def new_cache_entries(state: DataFrame, cache: DataFrame | None) -> DataFrame:
    """Entries to append to a cache table after an import.

    The oldest answer always wins, so a key already in the cache never changes: the table is
    append-only and a lookup is a plain join on unique keys.
    """
    fresh = cache_entries(state)
    if cache is None:
        return fresh
    known = cache.select(*[F.col(c).alias(f"known_{c}") for c in CACHE_KEYS])
    # Of the key only the fingerprint is an equality, so that a table in buckets of it stays in them.
    model, version = (F.col(c).between(F.col(f"known_{c}"), F.col(f"known_{c}")) for c in CACHE_KEYS[:2])
    return fresh.join(never_broadcast(known), (F.col("fingerprint") == F.col("known_fingerprint")) & model & version, "left_anti")


def cache_lookup(cache: DataFrame, model_id: str, prompt_version: str = S.PROMPT_VERSION) -> DataFrame:
    """``(fingerprint, cached_output)`` from a cache table for one model and prompt version."""
    return cache.filter((F.col("llm_model") == model_id) & (F.col("llm_prompt_version") == prompt_version)).select(
        "fingerprint", F.col("llm_output").alias("cached_output")
    )


def parse_decision(text: Column) -> Column:
    """X9 + L3: parsed answer, or null when the text is not a valid decision."""
    p = F.from_json(text, S.MODEL_DECISION_SCHEMA)
    ok = (
        p.getField("decision").isin(*S.MODEL_DECISIONS)
        & p.getField("confidence").between(0.0, 1.0)
        & p.getField("reason").isNotNull()
    )
    fixed = F.struct(
        p.getField("decision").alias("decision"),
        p.getField("confidence").alias("confidence"),
        F.coalesce(p.getField("candidate_product_ids"), F.array().cast("array<string>")).alias("candidate_product_ids"),
        p.getField("reason").alias("reason"),
    )
    return F.when(F.coalesce(ok, F.lit(False)), fixed)


def table_resolver(decisions: DataFrame, keys: tuple[str, ...] = ("fingerprint",)) -> Resolver:
    """Resolver backed by a table ``(*keys, llm_output, llm_error)`` (default key: fingerprint)."""
    d = decisions.select(*keys, "llm_output", "llm_error")

    def run(rows: DataFrame) -> DataFrame:
        return rows.join(never_broadcast(d), list(keys), "left").withColumn(
            "llm_error",
            F.when(
                F.col("llm_output").isNull() & F.col("llm_error").isNull(),
                F.lit("LookupError: no decision for fingerprint"),
            ).otherwise(F.col("llm_error")),
        )

    return run


#: Fields of a record as a Python resolver gets them.
RECORD_FIELDS = ("submission_id", "name", "producer", "category", "vintage", "size_ml")


def function_resolver(
    fn: Callable[[dict], str], *, materialize: bool = True, concurrency: int = 8, attempts: int = 2
) -> Resolver:
    """Resolver calling ``fn(record) -> JSON text`` for each row of an Arrow batch.

    Records hold plain Python values whatever the batch: a null is None, an integer an int.
    Up to ``concurrency`` calls of a task run at a time and each is tried up to ``attempts``
    times; the last exception becomes ``llm_error = "Type: message"`` (L2, L5) and never fails
    the import.  With ``materialize`` the answers are written once as a stage table before
    anything reads them, so a model is not called again when the plan reads the answers twice
    or a later stage is recomputed.
    """

    def ask(record: dict) -> tuple[str | None, str | None]:
        for attempt in range(attempts):
            try:
                return fn(record), None
            except Exception as e:  # noqa: BLE001 - any resolver failure routes to review
                error = f"{type(e).__name__}: {e}"
        return None, error

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for batch in it:
                answers = list(pool.map(ask, batch.select(list(RECORD_FIELDS)).to_pylist()))
                columns = [*batch.columns, *(pa.array(x, pa.string()) for x in (list(zip(*answers)) or [[], []]))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "llm_output", "llm_error"])

    def run(rows: DataFrame) -> DataFrame:
        schema = T.StructType(rows.schema.fields + [
            T.StructField("llm_output", T.StringType()),
            T.StructField("llm_error", T.StringType()),
        ])
        share_package(rows.sparkSession)
        answered = rows.mapInArrow(batches, schema)
        if materialize:
            from vinculum.sources.store import stage_table

            answered = stage_table(answered, "answers")
        return answered

    return run


def resolve_unmatched(
    state: DataFrame,
    resolver: Resolver,
    *,
    history: DataFrame | None,
    catalog_ids: DataFrame,
    model_id: str,
    run_ts: _dt.datetime | Column,
    prompt_version: str | Column = S.PROMPT_VERSION,
    null_candidate_to_review: bool = True,
    cache: DataFrame | None = None,
) -> DataFrame:
    """Unmatched -> matched (possible_match) / review / no_match, with the audit columns.

    Cached answers are used first; only misses reach ``resolver``.  Divergences from a naive
    reading, each documented in the README: a high-confidence answer without a (known)
    candidate goes to review (H6, H7, flag ``null_candidate_to_review``); a malformed cached
    answer is a cache miss (H8).

    The cache is either ``cache`` (a cache table, see :func:`new_cache_entries`) or derived
    from ``history`` (stored rows of earlier imports).  ``run_ts`` and ``prompt_version`` may
    be columns (per-row values, e.g. when replaying stored answers); then no cache is used.
    """
    ts_col = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")
    version_col = prompt_version if isinstance(prompt_version, Column) else F.lit(prompt_version)
    is_un = F.col("status") == "unmatched"
    rest = state.filter(~is_un | is_un.isNull())
    un = state.filter(is_un)
    if cache is not None or history is not None:
        assert isinstance(prompt_version, str), "a cache lookup needs one prompt version"
        hits = (
            cache_lookup(cache, model_id, prompt_version)
            if cache is not None
            else decision_cache(history, model_id, prompt_version)
        )
        un = un.join(never_broadcast(hits), "fingerprint", "left")
    else:
        un = un.withColumn("cached_output", F.lit(None).cast("string"))
    un = un.withColumn("cached", parse_decision(F.col("cached_output")))
    hits = un.filter(F.col("cached").isNotNull()).withColumn("llm_source", F.lit("cache")).withColumn(
        "llm_output", F.col("cached_output")
    ).withColumn("llm_error", F.lit(None).cast("string"))
    misses = resolver(un.filter(F.col("cached").isNull()).drop("llm_output")).withColumn("llm_source", F.lit("model"))
    both = hits.unionByName(misses)

    parsed = parse_decision(F.col("llm_output"))
    both = both.withColumn("answer", F.when(F.col("llm_error").isNull(), parsed)).withColumn(
        "llm_error",
        F.when(
            F.col("llm_error").isNull() & F.col("answer").isNull(),
            F.lit("ValidationError: model output is not a valid decision"),
        ).otherwise(F.col("llm_error")),
    )
    both = both.withColumn("cand", first_or_null(F.col("answer.candidate_product_ids")))
    # H7: keep only candidates the catalog knows, by the id column alone.  Answers without a
    # candidate stay out of the join, and both its sides are shuffled for it: neither null nor a
    # popular candidate makes a hot partition.
    known = catalog_ids.select(F.col("product_id").alias("cand")).distinct().withColumn("cand_known", F.lit(True))
    named = both.filter(F.col("cand").isNotNull()).join(never_broadcast(reshuffled(known, "cand")), "cand", "left")
    nameless = both.filter(F.col("cand").isNull()).withColumn("cand_known", F.lit(None).cast("boolean"))
    both = named.unionByName(nameless)

    err = F.col("llm_error").isNotNull()
    dec = F.col("answer.decision")
    conf = F.col("answer.confidence")
    cand = F.when(F.coalesce(F.col("cand_known"), F.lit(False)), F.col("cand"))
    is_no = dec == "no_match"
    low = (dec == "human_review") | (conf < S.AUTO_APPLY_THRESHOLD)
    if null_candidate_to_review:
        low = low | cand.isNull()
        pid_for_match = cand
    else:
        pid_for_match = F.col("cand")

    null = F.lit(None).cast("string")
    status = F.when(err, "review").when(is_no, "no_match").when(low, "review").otherwise("matched")
    decision = F.when(err, "human_review").when(is_no, "no_match").when(low, "human_review").otherwise("possible_match")
    pid = F.when(err | is_no, null).when(low, cand).otherwise(pid_for_match)
    expl = (
        F.when(err, S.LLM_UNAVAILABLE)
        .when(is_no, S.LLM_NO_MATCH)
        .when(low, S.LLM_HUMAN_REVIEW)
        .otherwise(S.LLM_POSSIBLE_MATCH)
    )
    out = (
        both.withColumn("status", status)
        .withColumn("decision", decision)
        .withColumn("matched_product_id", pid)
        .withColumn("explanation", expl)
        .withColumn("llm_confidence", F.when(~err, conf))
        .withColumn("llm_reason", F.when(err, F.col("llm_error")).otherwise(F.col("answer.reason")))
        .withColumn("llm_model", F.lit(model_id))
        .withColumn("llm_prompt_version", version_col)
        .withColumn("llm_output", F.when(~err, F.col("llm_output")))
        .withColumn("llm_source", F.when(err, "error").otherwise(F.col("llm_source")))
        .withColumn("updated_at", ts_col)
    )
    return rest.unionByName(out.select(*state.columns))


def llm_summary(state: DataFrame) -> DataFrame:
    """Processed, cache_hits, api_errors, auto_applied, sent_to_review (errors included), no_matches."""
    src = F.col("llm_source")
    e = F.col("explanation")
    return state.agg(
        F.count_if(src.isNotNull()).alias("processed"),
        F.count_if(src == "cache").alias("cache_hits"),
        F.count_if(src == "error").alias("api_errors"),
        F.count_if(src.isNotNull() & (e == S.LLM_POSSIBLE_MATCH)).alias("auto_applied"),
        F.count_if(src.isNotNull() & e.isin(S.LLM_HUMAN_REVIEW, S.LLM_UNAVAILABLE)).alias("sent_to_review"),
        F.count_if(src.isNotNull() & (e == S.LLM_NO_MATCH)).alias("no_matches"),
    )


# --- requests (L1) --------------------------------------------------------------------------


def user_message(c_id: Column, name: Column, producer: Column, category: Column, vintage: Column, size: Column) -> Column:
    """L1 user text: the six submission fields in one line, a dash for what is missing."""

    def part(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"{label}="), F.coalesce(value.cast("string"), F.lit("-")))

    fields = [("id", c_id), ("name", name), ("producer", producer), ("category", category), ("vintage", vintage), ("ml", size)]
    return F.concat(F.lit("Which product is this? "), F.array_join(F.array(*[part(k, v) for k, v in fields]), "; "))


def catalog_line(cat: DataFrame) -> Column:
    """One catalog line: ``product_id: producer / canonical_name (category, size ml[, needs vintage])``."""
    return F.concat(
        F.col("product_id"), F.lit(": "), F.col("producer"), F.lit(" / "), F.col("canonical_name"),
        F.lit(" ("), F.col("category"), F.lit(", "), F.col("size_ml").cast("string"), F.lit(" ml"),
        F.when(F.col("vintage_required"), F.lit(", needs vintage")).otherwise(F.lit("")), F.lit(")"),
    )


#: A token is rare where at most RARE_PRODUCTS products of its category, and at most one in
#: RARE_ONE_IN of them, hold it.
RARE_PRODUCTS = 500
RARE_ONE_IN = 20
#: Edits by which a submitted producer may differ from the catalog's.
PRODUCER_EDITS = 2


def _unmatched(state: DataFrame, aliases: DataFrame) -> DataFrame:
    """Unmatched rows with block_producer, the alias-aware key of their catalog block."""
    return with_producer_key(state.filter(F.col("status") == "unmatched"), aliases).withColumnRenamed(
        "producer_key", "block_producer"
    )


def _blocks(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy(F.lower("producer").alias("block_producer"), "category").agg(F.count(F.lit(1)).alias("block_products"))


def _without_block(state: DataFrame, catalog: DataFrame, aliases: DataFrame) -> DataFrame:
    """Unmatched rows whose producer key has no block in their category."""
    known = reshuffled(_blocks(catalog), "block_producer")
    return _unmatched(state, aliases).join(known, ["block_producer", "category"], "left_anti")


def _token_sets(catalog: DataFrame) -> DataFrame:
    """(category, held, product_id): products with the set of their producer's and name's tokens."""
    words = tokens(normalize(F.concat_ws(" ", "producer", "canonical_name")))
    return catalog.select("category", F.array_sort(words).alias("held"), "product_id")


def _weighted_tokens(held: DataFrame) -> DataFrame:
    """(category, token, df, weight, rare): products with the token, ln(1 + products / df) in millionths.

    ``held``: distinct token sets (category, held) with their number ``n`` of products."""
    freq = held.select("category", "n", F.explode("held").alias("token")).groupBy("category", "token").agg(F.sum("n").alias("df"))
    sizes = held.groupBy("category").agg(F.sum("n").alias("products"))
    weight = F.round(F.ln(1 + F.col("products") / F.col("df")) * 1e6).cast("long")
    rare = (F.col("df") <= RARE_PRODUCTS) & (F.col("df") * RARE_ONE_IN <= F.col("products"))
    return freq.join(sizes, "category").select("category", "token", "df", weight.alias("weight"), rare.alias("rare"))


def _asked(state: DataFrame, catalog: DataFrame, aliases: DataFrame) -> DataFrame:
    """(submission_id, category, words): rows without a block, and their tokens to search by."""
    words = tokens(normalize(F.concat_ws(" ", "producer", "name")))
    return _without_block(state, catalog, aliases).select("submission_id", "category", F.array_sort(words).alias("words"))


def _found_sets(asked: DataFrame, catalog: DataFrame) -> DataFrame:
    """(category, words, held, n, shared, weight): the products' token sets that each asked set finds.

    The rare tokens are the prefix of a set-similarity join: only they are joined, a pair is
    written for the first of them that both sides hold, and the weight of common tokens is
    added from the two sets.  The search runs once per distinct token set of either side; ``n``
    products have the set.  Exploded sets are many times their files' bytes, by which Spark
    would choose to broadcast them, so these joins are merge joins.
    """
    sets = asked.select("category", "words").distinct()
    held = _token_sets(catalog).groupBy("category", "held").agg(F.count(F.lit(1)).alias("n"))
    weighted = _weighted_tokens(held)
    known = (
        sets.select("*", F.explode("words").alias("token"))
        .join(reshuffled(weighted, "token").hint("merge"), ["category", "token"])
        .groupBy("category", "words")
        .agg(F.array_sort(F.collect_list(F.struct("token", "weight", "rare", "df"))).alias("known"))
        .withColumn("least", F.array_min(F.transform("known", lambda x: x["df"])))
    )
    prefix = F.transform(F.filter("known", lambda x: x["rare"] | (x["df"] == F.col("least"))), lambda x: x["token"])
    probes = known.withColumn("prefix", prefix).select("category", "words", "known", "prefix", F.explode("prefix").alias("token"))
    posting = held.select("*", F.explode("held").alias("token"))
    first = F.array_intersect("prefix", "held")[0] == F.col("token")
    both = F.filter("known", lambda x: F.array_contains(F.col("held"), x["token"]))
    return probes.join(posting.hint("merge"), ["category", "token"]).filter(first).select(
        "category",
        "words",
        "held",
        "n",
        F.size(F.array_intersect("words", "held")).alias("shared"),
        F.aggregate(both, F.lit(0).cast("long"), lambda total, x: total + x["weight"]).alias("weight"),
    )


def request_candidates(state: DataFrame, catalog: DataFrame, aliases: DataFrame) -> DataFrame:
    """L1 context of rows whose producer has no block in the catalog (unknown or misspelt).

    ``(submission_id, product_id, shared, weight, rank)``: within the category, every product
    that shares one of the row's rare tokens (of producer and name), with the number of all
    shared tokens and the sum of their weights; products of equal weight share a rank, and the
    list isn't cut.  A row without a rare token is searched by its rarest known ones.

    Ranks are found among token sets (:func:`_found_sets`), a set counting as many times as
    products have it; only the last join writes a row per product.
    """
    asked = _asked(state, catalog, aliases)
    found = _found_sets(asked, catalog)
    upto = F.sum("n").over(Window.partitionBy("category", "words").orderBy(F.desc("weight")))  # its equals included
    equals = F.sum("n").over(Window.partitionBy("category", "words", "weight"))
    ranked = found.withColumn("rank", (upto - equals + 1).cast("int")).drop("n")
    rows = asked.join(ranked.hint("merge"), ["category", "words"]).select("submission_id", "category", "held", "shared", "weight", "rank")
    return rows.join(_token_sets(catalog).hint("merge"), ["category", "held"]).select("submission_id", "product_id", "shared", "weight", "rank")


def _deletions(key: Column, edits: int) -> Column:
    """The strings that ``edits`` deletions or fewer make of a string, itself included."""

    def shorter(text: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.length(text)), lambda i: i > 0)
        return F.transform(places, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))

    found = F.array(key)
    last = found
    for _ in range(edits):
        last = F.array_distinct(F.flatten(F.transform(last, shorter)))
        found = F.concat(found, last)
    return F.array_distinct(found)


def near_blocks(state: DataFrame, catalog: DataFrame, aliases: DataFrame, edits: int = PRODUCER_EDITS) -> DataFrame:
    """Catalog blocks of a producer that a row without a block may have misspelt.

    ``(submission_id, category, block_producer, distance, block_products)``: the blocks of the
    row's category whose producer differs from the submitted one by at most ``edits`` edits
    (exact Levenshtein distance of the normalised names).  Two names within ``edits`` edits
    share a string that each becomes by as many deletions, so candidates come from an equi-join
    on these, once per distinct producer.
    """
    rows = _without_block(state, catalog, aliases).select("submission_id", "category", F.col("block_producer").alias("asked"))
    blocks = _blocks(catalog).withColumn("name", normalize(F.col("block_producer")))
    asked = rows.select("category", "asked").distinct().withColumn("asked_name", normalize(F.col("asked")))
    left = asked.select("*", F.explode(_deletions(F.col("asked_name"), edits)).alias("variant"))
    right = blocks.select("*", F.explode(_deletions(F.col("name"), edits)).alias("variant"))
    distance = F.levenshtein("asked_name", "name").alias("distance")
    near = left.join(right.hint("merge"), ["category", "variant"]).select("category", "asked", "block_producer", "block_products", distance)
    near = near.filter(F.col("distance") <= edits).distinct()
    return rows.join(reshuffled(near, "asked"), ["category", "asked"]).select(
        "submission_id", "category", "block_producer", "distance", "block_products"
    )


def request_table(state: DataFrame, catalog: DataFrame, aliases: DataFrame) -> DataFrame:
    """L1: one request per unmatched row: its user text and the size of its context.

    The model context is the row's producer/category block under its alias-aware producer key
    (the whole catalog does not fit a prompt at millions of products), or, without such a block,
    the products that :func:`request_candidates` finds, here only counted, and the blocks of
    :func:`near_blocks`.
    Context lines stay tables, keyed by block (:func:`block_context`) or row; they are never
    concatenated into one value.
    """
    req = _unmatched(state, aliases).select(
        "submission_id",
        "fingerprint",
        "block_producer",
        "category",
        user_message(
            F.col("submission_id"), F.col("name"), F.col("producer"), F.col("category"), F.col("vintage"), F.col("size_ml")
        ).alias("user_text"),
    )
    asked = _asked(state, catalog, aliases)
    found = _found_sets(asked, catalog).groupBy("category", "words").agg(F.sum("n").alias("found"))
    searched = asked.join(reshuffled(found, "category"), ["category", "words"]).groupBy("submission_id").agg(F.sum("found").alias("found_products"))
    near = near_blocks(state, catalog, aliases).groupBy("submission_id").agg(F.count(F.lit(1)).alias("near_blocks"))
    counted = searched.join(near, "submission_id", "full")
    return (
        req.join(reshuffled(_blocks(catalog), "block_producer"), ["block_producer", "category"], "left")
        .join(counted, "submission_id", "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("block_products", "found_products", "near_blocks")})
    )


def block_context(catalog: DataFrame) -> DataFrame:
    """L1 context table: catalog lines per (producer, category) block."""
    return catalog.select(
        F.lower("producer").alias("block_producer"), "category", "product_id", catalog_line(catalog).alias("line")
    )


SYSTEM_HEAD = (
    "You are given one submitted wine or spirit and lines of a product catalog. Name tokens, known other names of "
    "producers and sizes have been compared already without a clear result. Decide whether one of the lines is the "
    "same product: possible_match, no_match or human_review. Another size is another product. When in doubt, choose "
    "human_review."
)


def system_lines(aliases: DataFrame) -> DataFrame:
    """L1 system text as lines ``(block_producer, line)``: the policy, which every request gets
    (null producer), and for a producer's requests the other names it is known by."""
    names = aliases.select(
        F.lower("canonical").alias("block_producer"),
        F.concat(F.col("canonical"), F.lit(" is also called "), F.col("alias")).alias("line"),
    )
    head = aliases.sparkSession.range(1).select(F.lit(None).cast("string").alias("block_producer"), F.lit(SYSTEM_HEAD).alias("line"))
    return head.unionByName(names)
