"""DuckDB oracle SQL for the registered queries.

The oracle re-derives the whole import in plain SQL over the driver's tables, written
independently of the Spark plan: windows where Spark uses aggregates, a brute-force
producer/category join with ``list_has_all`` where Spark uses the rarest-token join, JSON
functions to read the tier-2 answers.  Each query is ``WITH <chain> SELECT ...``.
"""

from __future__ import annotations

from vinculum import schemas as S
from vinculum.operators import resolve as R
from vinculum.sources.tables import UNKNOWN_PRODUCT

_SIZES = "[" + ", ".join(str(s) for s in S.SIZES_ML) + "]"
_CATS = ", ".join(f"'{c}'" for c in S.CATEGORIES)
_SIZE_LIST = ", ".join(str(s) for s in S.SIZES_ML)
_TRIM = r"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_NORM = r"trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_TOK = "list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> ''))"
_ALIASES = ", ".join(f"('{a}', '{c}')" for a, c in S.PRODUCER_ALIASES)
_CATEGORY = (
    "CASE p_type WHEN 'ECONOMY' THEN 'Wine' WHEN 'LARGE' THEN 'Whisky' WHEN 'MEDIUM' THEN 'Bourbon' "
    "WHEN 'PROMO' THEN 'Tequila' WHEN 'SMALL' THEN 'Rum' ELSE 'Cognac' END"
)
_DECISIONS = "[" + ", ".join(f"'{d}'" for d in S.MODEL_DECISIONS) + "]"
MODEL = S.DEFAULT_MODEL


def _sql_str(text: str) -> str:
    """A SQL string expression for ``text`` (newlines as chr(10), quotes doubled)."""
    parts = ["'" + p.replace("'", "''") + "'" for p in text.split("\n")]
    return " || chr(10) || ".join(parts)


def trim_u(x: str) -> str:
    return _TRIM.format(x=x)


def norm(x: str) -> str:
    return _NORM.format(x=x)


def toks(x: str) -> str:
    return _TOK.format(x=x)


#: The product an answer names: by the third hex digit an unknown one, none, or the block's first.
_CAND = (
    "CASE WHEN substr({fp}, 3, 1) IN ('0', '1') THEN '" + UNKNOWN_PRODUCT + "' "
    "WHEN substr({fp}, 3, 1) <> '2' THEN {cand} END"
)


def _json(b: str, cand: str) -> str:
    return (
        f"""'{{"decision":"' || ({_DECISIONS})[({b}) % 4 + 1] || '","confidence":' || """
        f"""CAST(CAST((({b}) + 4) / 20.0 AS DECIMAL(3,2)) AS VARCHAR) || ',"candidate_product_ids":' || """
        f"""CASE WHEN {cand} IS NULL THEN '[]' ELSE '["' || {cand} || '"]' END || """
        f"""',"reason":"rule bucket ' || CAST({b} AS VARCHAR) || '"}}'"""
    )


CHAIN = f"""
cat AS (
  SELECT 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS product_id,
         p_name || ' series ' || CAST(p_partkey % 40 AS VARCHAR) AS canonical_name,
         p_brand AS producer,
         {_CATEGORY} AS category,
         ({_SIZES})[p_size % 11 + 1] AS size_ml,
         p_partkey % 5 = 0 AS vintage_required
  FROM part
),
li AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity, l.l_shipdate,
         p.p_partkey, p.p_name, p.p_brand, p.p_size, {_CATEGORY} AS pcat,
         (l.l_orderkey * 7 + l.l_linenumber) % 20 AS k,
         p.p_name || ' series ' || CAST(p.p_partkey % 40 AS VARCHAR) AS nm
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
raw0 AS (
  SELECT CASE WHEN k = 3 AND l_linenumber = 5 THEN NULL WHEN k = 3 AND l_linenumber = 4 THEN ''
              ELSE 'SUB-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS submission_id,
         CASE WHEN k = 6 THEN upper(nm) WHEN k = 7 THEN replace(nm, ' ', '-') WHEN k = 8 THEN p_name
              WHEN k = 13 THEN '' WHEN k = 17 THEN substr(p_name, 1, 3) || ' srs'
              WHEN k = 18 THEN chr(160) || chr(12288) || nm || chr(8195) || ' ' WHEN k = 19 THEN '!!!' ELSE nm END AS name,
         CASE WHEN k = 12 THEN NULL WHEN k = 9 OR (k = 17 AND l_linenumber = 3) THEN replace(lower(p_brand), '#', ' no ')
              WHEN k = 8 AND l_linenumber = 2 THEN replace(p_brand, 'Brand#', 'Brnd ') ELSE p_brand END AS producer,
         CASE WHEN k = 11 THEN 'Beer' ELSE pcat END AS category,
         CASE WHEN k = 15 THEN 1700 WHEN k = 16 OR (k = 17 AND l_suppkey % 3 = 0) THEN NULL
              ELSE year(l_shipdate) END AS vintage,
         CASE WHEN k = 14 THEN 800 WHEN k = 10 THEN ({_SIZES})[(p_size + 1) % 11 + 1]
              ELSE ({_SIZES})[p_size % 11 + 1] END AS size_ml,
         k, p_partkey, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_linenumber
  FROM li
),
raw AS (SELECT * FROM raw0 UNION ALL SELECT * FROM raw0 WHERE k = 4 AND l_linenumber = 6),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY submission_id
            ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS rn
  FROM raw WHERE submission_id IS NOT NULL AND submission_id <> ''
),
skipped AS (SELECT submission_id, 'duplicate_id' AS reason FROM ranked WHERE rn > 1),
kept AS (SELECT * FROM ranked WHERE rn = 1),
chk AS (
  SELECT *, {trim_u('name')} AS t_name, {trim_u('producer')} AS t_producer, {trim_u('category')} AS t_category
  FROM kept
),
errs AS (
  SELECT *,
    CASE WHEN name IS NULL THEN '{S.MSG_REQUIRED}' WHEN length(t_name) = 0 THEN '{S.MSG_STRING_EMPTY}' END AS e_name,
    CASE WHEN producer IS NULL THEN '{S.MSG_REQUIRED}' WHEN length(t_producer) = 0 THEN '{S.MSG_STRING_EMPTY}' END AS e_producer,
    CASE WHEN category IS NULL THEN '{S.MSG_REQUIRED}' WHEN length(t_category) = 0 THEN '{S.MSG_STRING_EMPTY}' END AS e_category,
    CASE WHEN vintage < {S.VINTAGE_MIN} THEN '{S.msg_vintage_low()}'
         WHEN vintage > {S.VINTAGE_MAX} THEN '{S.msg_vintage_high()}' END AS e_vintage,
    CASE WHEN size_ml IS NULL THEN '{S.MSG_REQUIRED}' WHEN size_ml NOT IN ({_SIZE_LIST}) THEN '{S.MSG_SIZE}' END AS e_size
  FROM chk
),
val AS (
  SELECT submission_id, k, p_partkey,
    CASE WHEN e_name IS NULL THEN t_name END AS name,
    CASE WHEN e_producer IS NULL THEN t_producer END AS producer,
    CASE WHEN e_category IS NULL THEN t_category END AS category,
    CASE WHEN e_vintage IS NULL THEN vintage END AS vintage,
    CASE WHEN e_size IS NULL THEN size_ml END AS size_ml,
    NULLIF(concat_ws('; ', 'name: ' || e_name, 'producer: ' || e_producer, 'category: ' || e_category,
                     'vintage: ' || e_vintage, 'size_ml: ' || e_size), '') AS validation_error
  FROM errs
),
val2 AS (
  SELECT *, CASE WHEN validation_error IS NULL THEN 'pending' ELSE 'invalid' END AS status0,
    CASE WHEN validation_error IS NULL THEN
      sha256(concat_ws('|', name, producer, category, coalesce(CAST(vintage AS VARCHAR), ''), CAST(size_ml AS VARCHAR)))
    END AS fingerprint
  FROM val
),
dd0 AS (
  SELECT *, min(submission_id) OVER (PARTITION BY fingerprint) AS surv, count(*) OVER (PARTITION BY fingerprint) AS fcnt
  FROM val2
),
dd AS (
  SELECT * EXCLUDE (surv, fcnt, status0),
    CASE WHEN fingerprint IS NOT NULL AND fcnt > 1 AND submission_id <> surv THEN 'exact_duplicate' ELSE status0 END AS status,
    CASE WHEN fingerprint IS NOT NULL AND fcnt > 1 AND submission_id <> surv THEN surv END AS duplicate_of
  FROM dd0
),
al AS (
  SELECT alias_key, min(canonical) AS canonical FROM (
    SELECT lower({trim_u('alias')}) AS alias_key, canonical FROM (VALUES {_ALIASES}) v(alias, canonical)
    UNION ALL
    SELECT lower(replace(lower(p_brand), '#', ' no ')), p_brand FROM (SELECT DISTINCT p_brand FROM part)
  ) GROUP BY alias_key
),
pend AS (
  SELECT d.*, lower(coalesce(al.canonical, d.producer)) AS pk, {norm('d.name')} AS norm
  FROM dd d LEFT JOIN al ON al.alias_key = lower({trim_u('d.producer')})
  WHERE d.status = 'pending'
),
ptok AS (SELECT *, {toks('norm')} AS s_tokens, category IN ({_CATS}) AS in_scope FROM pend),
ctok AS (
  SELECT product_id, lower(producer) AS pk, category, size_ml AS p_size, vintage_required,
         {toks(norm('canonical_name'))} AS p_tokens
  FROM cat
),
pairs AS (
  SELECT p.submission_id, c.product_id, c.p_size = p.size_ml AS at_size, c.vintage_required
  FROM ptok p JOIN ctok c ON c.pk = p.pk AND c.category = p.category AND list_has_all(c.p_tokens, p.s_tokens)
  WHERE p.in_scope
),
cnt AS (
  SELECT submission_id, count(*) FILTER (WHERE at_size) AS n_at_size, count(*) AS n_any,
         min(product_id) FILTER (WHERE at_size) AS first_pid,
         arg_min(vintage_required, product_id) FILTER (WHERE at_size) AS first_vreq
  FROM pairs GROUP BY submission_id
),
t1r AS (
  SELECT p.*, coalesce(c.n_at_size, 0) AS n_at, coalesce(c.n_any, 0) AS n_an, c.first_pid,
         coalesce(c.first_vreq, false) AS vreq
  FROM ptok p LEFT JOIN cnt c USING (submission_id)
),
t1 AS (
  SELECT submission_id, k, p_partkey, name, producer, category, vintage, size_ml, validation_error, fingerprint,
    duplicate_of, pk,
    CASE WHEN NOT in_scope THEN 'no_match' WHEN n_at = 1 AND vreq AND vintage IS NULL THEN 'review'
         WHEN n_at = 1 THEN 'matched' WHEN n_at > 1 THEN 'review' WHEN n_an = 1 THEN 'no_match'
         ELSE 'unmatched' END AS status,
    CASE WHEN NOT in_scope THEN 'no_match' WHEN n_at = 1 AND vreq AND vintage IS NULL THEN 'human_review'
         WHEN n_at = 1 THEN 'exact_match' WHEN n_at > 1 THEN 'human_review' WHEN n_an = 1 THEN 'no_match'
         END AS decision,
    CASE WHEN NOT in_scope THEN NULL WHEN n_at = 1 THEN first_pid END AS matched_product_id,
    CASE WHEN NOT in_scope THEN '{S.CATEGORY_MISMATCH}' WHEN n_at = 1 AND vreq AND vintage IS NULL
         THEN '{S.VINTAGE_REQUIRED_MISSING}' WHEN n_at = 1 THEN NULL WHEN n_at > 1 THEN '{S.MULTIPLE_CANDIDATES}'
         WHEN n_an = 1 THEN '{S.SIZE_ML_MISMATCH}' END AS explanation,
    n_at AS n_at_size, n_an AS n_any
  FROM t1r
),
st1 AS (
  SELECT submission_id, k, p_partkey, name, producer, category, vintage, size_ml, validation_error, fingerprint,
         duplicate_of, status, CAST(NULL AS VARCHAR) AS decision, CAST(NULL AS VARCHAR) AS matched_product_id,
         CAST(NULL AS VARCHAR) AS explanation, CAST(NULL AS VARCHAR) AS tier1_status
  FROM dd WHERE status <> 'pending'
  UNION ALL
  SELECT submission_id, k, p_partkey, name, producer, category, vintage, size_ml, validation_error, fingerprint,
         duplicate_of, status, decision, matched_product_id, explanation, status AS tier1_status
  FROM t1
),
blk AS (SELECT lower(producer) AS bpk, category AS bcat, min(product_id) AS cand FROM cat GROUP BY 1, 2),
un AS (
  SELECT s.*, strpos('0123456789abcdef', substr(s.fingerprint, 1, 1)) - 1 AS b,
         substr(s.fingerprint, 2, 1) AS d2, {_CAND.format(fp='s.fingerprint', cand='blk.cand')} AS cand
  FROM st1 s LEFT JOIN blk ON blk.bpk = lower(s.producer) AND blk.bcat = s.category
  WHERE s.status = 'unmatched'
),
cache AS (
  SELECT fingerprint,
    CASE WHEN (b + 1) % 16 <> 15 THEN {_json('(b + 1) % 16', 'cand')}
         WHEN (b + 2) % 16 <> 15 THEN {_json('(b + 2) % 16', 'cand')} END AS cached_output
  FROM (SELECT DISTINCT fingerprint, b, cand FROM un WHERE d2 IN ('0','2','4','6','8','a','c','e'))
),
ans AS (
  SELECT u.*, c.cached_output,
    CASE WHEN c.cached_output IS NOT NULL THEN 'cache' WHEN u.b = 15 THEN 'error' ELSE 'model' END AS llm_source,
    coalesce(c.cached_output, CASE WHEN u.b <> 15 THEN {_json('u.b', 'u.cand')} END) AS llm_output
  FROM un u LEFT JOIN cache c USING (fingerprint)
),
ans2 AS (
  SELECT *, json_extract_string(llm_output, '$.decision') AS a_dec,
         CAST(json_extract(llm_output, '$.confidence') AS DOUBLE) AS a_conf,
         json_extract_string(llm_output, '$.candidate_product_ids[0]') AS a_named,
         CASE WHEN json_extract_string(llm_output, '$.candidate_product_ids[0]') IN (SELECT product_id FROM cat)
              THEN json_extract_string(llm_output, '$.candidate_product_ids[0]') END AS a_cand,
         json_extract_string(llm_output, '$.reason') AS a_reason
  FROM ans
),
t2 AS (
  SELECT submission_id, llm_source, llm_output,
    CASE WHEN llm_source = 'error' THEN 'review' WHEN a_dec = 'no_match' THEN 'no_match'
         WHEN a_dec = 'human_review' OR a_conf < {S.AUTO_APPLY_THRESHOLD} OR a_cand IS NULL THEN 'review'
         ELSE 'matched' END AS status,
    CASE WHEN llm_source = 'error' THEN 'human_review' WHEN a_dec = 'no_match' THEN 'no_match'
         WHEN a_dec = 'human_review' OR a_conf < {S.AUTO_APPLY_THRESHOLD} OR a_cand IS NULL THEN 'human_review'
         ELSE 'possible_match' END AS decision,
    CASE WHEN llm_source = 'error' OR a_dec = 'no_match' THEN NULL ELSE a_cand END AS matched_product_id,
    CASE WHEN llm_source = 'error' THEN '{S.LLM_UNAVAILABLE}' WHEN a_dec = 'no_match' THEN '{S.LLM_NO_MATCH}'
         WHEN a_dec = 'human_review' OR a_conf < {S.AUTO_APPLY_THRESHOLD} OR a_cand IS NULL THEN '{S.LLM_HUMAN_REVIEW}'
         ELSE '{S.LLM_POSSIBLE_MATCH}' END AS explanation,
    CASE WHEN llm_source <> 'error' THEN a_conf END AS llm_confidence,
    CASE WHEN llm_source = 'error' THEN 'ResolverError: no answer for bucket 15' ELSE a_reason END AS llm_reason
  FROM ans2
),
st2a AS (
  SELECT s.submission_id, s.k, s.p_partkey, s.name, s.producer, s.category, s.vintage, s.size_ml,
         s.validation_error, s.fingerprint, s.duplicate_of, s.tier1_status,
         coalesce(t.status, s.status) AS status,
         CASE WHEN t.submission_id IS NULL THEN s.decision ELSE t.decision END AS decision,
         CASE WHEN t.submission_id IS NULL THEN s.matched_product_id ELSE t.matched_product_id END AS matched_product_id,
         CASE WHEN t.submission_id IS NULL THEN s.explanation ELSE t.explanation END AS explanation,
         t.llm_confidence, t.llm_reason, t.llm_source, t.llm_output,
         CASE WHEN t.submission_id IS NULL THEN NULL ELSE '{MODEL}' END AS llm_model
  FROM st1 s LEFT JOIN t2 t USING (submission_id)
),
st2 AS (
  SELECT a.* REPLACE (
      CASE WHEN a.status = 'exact_duplicate' THEN sv.matched_product_id ELSE a.matched_product_id END AS matched_product_id,
      CASE WHEN a.status = 'exact_duplicate' THEN sv.decision ELSE a.decision END AS decision)
  FROM st2a a LEFT JOIN st2a sv ON a.duplicate_of = sv.submission_id AND a.status = 'exact_duplicate'
),
nd AS (
  SELECT *, min(submission_id) OVER (PARTITION BY matched_product_id) AS nsurv,
         count(*) OVER (PARTITION BY matched_product_id) AS ncnt
  FROM st2 WHERE status = 'matched'
),
fin AS (
  SELECT * FROM st2 WHERE status <> 'matched'
  UNION ALL
  SELECT * EXCLUDE (nsurv, ncnt) REPLACE (
      CASE WHEN ncnt > 1 AND submission_id <> nsurv THEN 'near_duplicate' ELSE status END AS status,
      CASE WHEN ncnt > 1 AND submission_id <> nsurv THEN nsurv ELSE duplicate_of END AS duplicate_of)
  FROM nd
),
lab AS (
  SELECT submission_id,
    CASE WHEN k IN (10, 11, 12, 13, 14, 15, 19) THEN NULL ELSE 'PROD-' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') END
      AS expected_product_id,
    CASE WHEN k IN (12, 13, 14, 15) THEN ['invalid'] WHEN k IN (10, 11) THEN ['no_match']
         WHEN k = 9 THEN ['exact_match', 'possible_match'] WHEN k IN (8, 17) THEN ['human_review', 'possible_match']
         WHEN k = 19 THEN ['human_review'] ELSE ['exact_match'] END AS acceptable_decisions
  FROM kept
),
sc AS (
  SELECT l.submission_id, l.expected_product_id, l.acceptable_decisions, f.status, f.decision,
         f.matched_product_id, f.llm_confidence, f.llm_model,
         f.submission_id IS NOT NULL AS found,
         list_contains(l.acceptable_decisions, 'invalid') AS by_status,
         (f.status = 'invalid' AND f.matched_product_id IS NULL) AS inv_ok,
         (f.matched_product_id IS NOT DISTINCT FROM l.expected_product_id) AS pid_ok,
         coalesce(list_contains(l.acceptable_decisions, f.decision), false) AS dec_ok,
         '{{' || array_to_string(list_sort(l.acceptable_decisions), ', ') || '}}' AS class_key
  FROM lab l LEFT JOIN fin f USING (submission_id)
),
sc2 AS (
  SELECT *,
    CASE WHEN NOT found THEN false WHEN by_status THEN inv_ok ELSE pid_ok END AS pid_correct,
    CASE WHEN NOT found THEN false WHEN by_status THEN inv_ok ELSE dec_ok END AS decision_correct,
    CASE WHEN NOT found THEN false WHEN by_status THEN inv_ok ELSE pid_ok AND dec_ok END AS correct,
    found AND NOT by_status AND NOT pid_ok AND coalesce(decision IN ('exact_match', 'possible_match'), false)
      AS false_positive,
    CASE WHEN NOT found THEN NULL WHEN by_status THEN 'invalid (status)' ELSE coalesce(decision, '(null)') END AS emitted
  FROM sc
)
"""

# Tier 2 that applies a confident answer whatever product it names, and its propagation.
UNCHECKED = f""",
t2u AS (
  SELECT submission_id,
    CASE WHEN llm_source = 'error' THEN 'review' WHEN a_dec = 'no_match' THEN 'no_match'
         WHEN a_dec = 'human_review' OR a_conf < {S.AUTO_APPLY_THRESHOLD} THEN 'review' ELSE 'matched' END AS status,
    CASE WHEN llm_source = 'error' THEN 'human_review' WHEN a_dec = 'no_match' THEN 'no_match'
         WHEN a_dec = 'human_review' OR a_conf < {S.AUTO_APPLY_THRESHOLD} THEN 'human_review'
         ELSE 'possible_match' END AS decision,
    CASE WHEN llm_source = 'error' OR a_dec = 'no_match' THEN NULL
         WHEN a_dec = 'human_review' OR a_conf < {S.AUTO_APPLY_THRESHOLD} THEN a_cand ELSE a_named END AS matched_product_id,
    CASE WHEN llm_source = 'error' THEN '{S.LLM_UNAVAILABLE}' WHEN a_dec = 'no_match' THEN '{S.LLM_NO_MATCH}'
         WHEN a_dec = 'human_review' OR a_conf < {S.AUTO_APPLY_THRESHOLD} THEN '{S.LLM_HUMAN_REVIEW}'
         ELSE '{S.LLM_POSSIBLE_MATCH}' END AS explanation
  FROM ans2
),
ua AS (
  SELECT s.submission_id, s.duplicate_of, coalesce(t.status, s.status) AS status,
         CASE WHEN t.submission_id IS NULL THEN s.matched_product_id ELSE t.matched_product_id END AS matched_product_id
  FROM st1 s LEFT JOIN t2u t USING (submission_id)
),
unchecked AS (
  SELECT a.submission_id, a.duplicate_of,
         CASE WHEN a.status = 'exact_duplicate' THEN sv.matched_product_id ELSE a.matched_product_id END AS matched_product_id
  FROM ua a LEFT JOIN ua sv ON a.duplicate_of = sv.submission_id AND a.status = 'exact_duplicate'
)
"""


def q(select: str) -> str:
    return "WITH " + CHAIN.strip() + "\n" + select


def _status_order(c: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} = '{s}' THEN {i + 1}" for i, s in enumerate(S.STATUSES)) + " END"


def queries() -> dict[str, str]:
    so = _status_order("status")
    return {
        "catalog_find": "WITH " + CHAIN.strip().split("\n),\nli AS")[0] + "\n)\n"
        "SELECT product_id, canonical_name, producer, category, size_ml, vintage_required FROM cat "
        "WHERE lower(producer) = lower('brand#13') AND category = 'Rum'",
        "catalog_uniqueness": q(
            "SELECT canonical_name, producer, size_ml, count(*) AS n FROM cat "
            "GROUP BY canonical_name, producer, size_ml HAVING count(*) > 1"
        ),
        "missing_id_filter": q(
            "SELECT CASE WHEN submission_id IS NULL OR submission_id = '' THEN 'missing_id' ELSE 'has_id' END AS outcome, "
            "count(*) AS n FROM raw GROUP BY 1"
        ),
        "duplicate_ids_skipped": q(
            "SELECT submission_id, 'missing_id' AS reason, count(*) AS n FROM raw "
            "WHERE submission_id IS NULL OR submission_id = '' GROUP BY 1 "
            "UNION ALL SELECT submission_id, 'duplicate_id', count(*) - 1 FROM raw "
            "WHERE submission_id <> '' GROUP BY 1 HAVING count(*) > 1"
        ),
        "import_summary": q(
            "SELECT 'total' AS metric, count(*) AS value FROM raw UNION ALL "
            "SELECT 'skipped_missing_id', count(*) FILTER (WHERE submission_id IS NULL OR submission_id = '') FROM raw "
            "UNION ALL SELECT 'skipped_invalid_id', 0 UNION ALL SELECT 'skipped_invalid_record', 0 UNION ALL "
            "SELECT 'skipped_duplicate_id', count(*) - count(DISTINCT submission_id) FROM raw WHERE submission_id <> '' UNION ALL "
            "SELECT 'with_id', count(*) FILTER (WHERE submission_id IS NOT NULL AND submission_id <> '') FROM raw "
            "UNION ALL SELECT 'inserted', count(*) FROM kept"
        ),
        "validate_fields": q(
            "SELECT submission_id, status0 AS status, validation_error, name, producer, category, vintage, size_ml FROM val2"
        ),
        "invalid_with_reasons": q("SELECT submission_id, validation_error FROM val2 WHERE status0 = 'invalid'"),
        "normalize_names": q(f"SELECT submission_id, {norm('name')} AS norm FROM val2 WHERE name IS NOT NULL"),
        "token_sets": q(
            f"SELECT submission_id, array_to_string(list_sort({toks(norm('name'))}), ' ') AS tokens, "
            f"len({toks(norm('name'))}) AS n_tokens FROM val2 WHERE name IS NOT NULL"
        ),
        "fingerprints": q("SELECT submission_id, fingerprint FROM val2 WHERE fingerprint IS NOT NULL"),
        "exact_duplicate_groups": q(
            "SELECT fingerprint, count(*) AS n, min(submission_id) AS survivor "
            "FROM val2 WHERE fingerprint IS NOT NULL GROUP BY fingerprint HAVING count(*) > 1"
        ),
        "exact_duplicate_pairs": q("SELECT submission_id, duplicate_of FROM dd WHERE status = 'exact_duplicate'"),
        "exact_duplicate_summary": q(
            "SELECT count(DISTINCT duplicate_of) AS clusters, count(*) AS demoted FROM dd WHERE status = 'exact_duplicate'"
        ),
        "pending_queue": q("SELECT submission_id, name, producer, category, vintage, size_ml, fingerprint FROM dd "
                           "WHERE status = 'pending'"),
        "producer_alias": q("SELECT submission_id, producer, pk AS producer_key FROM pend"),
        "category_reject": q("SELECT submission_id, category FROM ptok WHERE NOT in_scope"),
        "candidate_pairs": q(
            "SELECT submission_id, product_id, at_size FROM pairs SEMI JOIN (SELECT submission_id FROM ptok "
            "WHERE len(s_tokens) > 0) USING (submission_id)"
        ),
        "candidate_counts": q("SELECT submission_id, n_at_size, n_any FROM t1 WHERE category IN (" + _CATS + ")"),
        "candidate_counts_dense": q("SELECT submission_id, n_at_size, n_any FROM t1 WHERE category IN (" + _CATS + ")"),
        "match_tier1": q("SELECT submission_id, status, decision, matched_product_id, explanation FROM t1"),
        "match_tier1_counts": q(
            "SELECT status, decision, explanation, count(*) AS n FROM t1 GROUP BY status, decision, explanation"
        ),
        "match_summary": q(
            "SELECT count(*) FILTER (WHERE status = 'matched') AS exact_matches, "
            "count(*) FILTER (WHERE status = 'review') AS human_reviews, "
            "count(*) FILTER (WHERE status = 'no_match') AS no_matches, "
            "count(*) FILTER (WHERE status = 'unmatched') AS unmatched FROM t1"
        ),
        "unmatched_queue": q(
            "SELECT submission_id, name, producer, category, vintage, size_ml, fingerprint FROM st1 "
            "WHERE status = 'unmatched'"
        ),
        "request_table": q(
            "SELECT t.submission_id, 'Which product is this? id=' || t.submission_id || '; name=' || t.name || '; producer=' "
            "|| t.producer || '; category=' || t.category || '; vintage=' || coalesce(CAST(t.vintage AS VARCHAR), '-') "
            "|| '; ml=' || CAST(t.size_ml AS VARCHAR) AS user_text, coalesce(b.n, 0) AS block_products, "
            "coalesce(s.n, 0) AS found_products, coalesce(e.n, 0) AS near_blocks FROM t1 t "
            "LEFT JOIN (SELECT lower(producer) AS bp, category AS bc, count(*) AS n FROM cat GROUP BY 1, 2) b "
            "ON b.bp = t.pk AND b.bc = t.category "
            "LEFT JOIN (SELECT submission_id, count(*) AS n FROM (" + _search_sql() + ") GROUP BY 1) s "
            "ON s.submission_id = t.submission_id "
            "LEFT JOIN (SELECT submission_id, count(*) AS n FROM (" + _near_sql() + ") GROUP BY 1) e "
            "ON e.submission_id = t.submission_id WHERE t.status = 'unmatched'"
        ),
        "request_candidates": q(_search_sql()),
        "request_near_blocks": q(_near_sql()),
        "apply_decisions_unchecked": q("").rstrip() + UNCHECKED
        + "SELECT submission_id, status, decision, matched_product_id, explanation FROM t2u",
        "decision_cache": q("SELECT fingerprint, cached_output FROM cache WHERE cached_output IS NOT NULL"),
        "apply_decisions": q(
            "SELECT submission_id, status, decision, matched_product_id, explanation, llm_confidence, llm_reason, "
            "llm_source FROM t2"
        ),
        "llm_summary": q(
            "SELECT count(*) AS processed, count(*) FILTER (WHERE llm_source = 'cache') AS cache_hits, "
            "count(*) FILTER (WHERE llm_source = 'error') AS api_errors, "
            f"count(*) FILTER (WHERE explanation = '{S.LLM_POSSIBLE_MATCH}') AS auto_applied, "
            f"count(*) FILTER (WHERE explanation IN ('{S.LLM_HUMAN_REVIEW}', '{S.LLM_UNAVAILABLE}')) AS sent_to_review, "
            f"count(*) FILTER (WHERE explanation = '{S.LLM_NO_MATCH}') AS no_matches FROM t2"
        ),
        "duplicate_propagation": q(
            "SELECT submission_id, duplicate_of, matched_product_id, decision FROM st2 WHERE status = 'exact_duplicate'"
        ),
        "near_duplicate_groups": q(
            "SELECT matched_product_id, count(*) AS n, min(submission_id) AS survivor FROM st2 "
            "WHERE status = 'matched' GROUP BY matched_product_id HAVING count(*) > 1"
        ),
        "near_duplicate_pairs": q(
            "SELECT submission_id, duplicate_of, matched_product_id FROM fin WHERE status = 'near_duplicate'"
        ),
        "status_counts": q(f"SELECT status, count(*) AS n, {so} AS status_order FROM fin GROUP BY status"),
        "review_queue": q(
            "SELECT submission_id, decision, matched_product_id, explanation FROM fin WHERE status = 'review'"
        ),
        "match_results": q(
            "SELECT submission_id, status, decision, llm_confidence AS confidence, "
            "coalesce(matched_product_id, '') AS candidate_product_ids, "
            "coalesce(explanation, validation_error) AS explanation FROM fin"
        ),
        "inspect_submissions": q(_inspect_sql()),
        "inspect_import": q(_inspect_sql()),
        "output_datasets": q(
            "SELECT 'valid_records' AS dataset, count(*) AS n FROM fin WHERE status <> 'invalid' "
            "UNION ALL SELECT 'invalid_records', count(*) FROM fin WHERE status = 'invalid' "
            "UNION ALL SELECT 'exact_duplicate_records', count(*) FROM fin WHERE status = 'exact_duplicate' "
            "UNION ALL SELECT 'near_duplicate_records', count(*) FROM fin WHERE status = 'near_duplicate' "
            "UNION ALL SELECT 'unmatched_records', count(*) FROM fin WHERE status IN ('unmatched', 'no_match', 'review')"
        ),
        "final_state": q(
            "SELECT submission_id, 'import-0001' AS import_id, name, producer, category, vintage, size_ml, status, decision, "
            "matched_product_id, explanation, llm_confidence, llm_reason, llm_model, "
            f"CASE WHEN llm_model IS NOT NULL THEN '{S.PROMPT_VERSION}' END AS llm_prompt_version, "
            "CASE WHEN llm_source <> 'error' THEN llm_output END AS llm_output, validation_error, duplicate_of, fingerprint, "
            "tier1_status, llm_source, '2026-01-01 00:00:00' AS created_at, '2026-01-01 00:00:00' AS updated_at FROM fin"
        ),
        "pipeline_report": q(_report_sql()),
        "eval_overall": q(
            "SELECT count(*) AS total, count(*) FILTER (WHERE pid_correct) AS pid_correct, "
            "count(*) FILTER (WHERE decision_correct) AS decision_correct, "
            "count(*) FILTER (WHERE false_positive) AS false_positives, count(*) FILTER (WHERE NOT found) AS not_found "
            "FROM sc2"
        ),
        "eval_decisions": q("SELECT emitted, count(*) AS n FROM sc2 WHERE emitted IS NOT NULL GROUP BY emitted"),
        "eval_tiers": q(
            "SELECT count(*) FILTER (WHERE llm_model IS NULL) AS tier1, count(*) FILTER (WHERE llm_model IS NOT NULL) AS tier2, "
            "round(avg(llm_confidence) FILTER (WHERE llm_model IS NOT NULL), 4) AS conf_mean, "
            "min(llm_confidence) FILTER (WHERE llm_model IS NOT NULL) AS conf_min, "
            "max(llm_confidence) FILTER (WHERE llm_model IS NOT NULL) AS conf_max FROM sc2 WHERE found"
        ),
        "eval_by_set": q(
            "SELECT class_key, count(*) FILTER (WHERE correct) AS correct, count(*) AS n FROM sc2 GROUP BY class_key"
        ),
        "eval_misses": q(_misses_sql()),
        "eval_percentages": q(
            "SELECT class_key, printf('%.1f%%', 100.0 * count(*) FILTER (WHERE correct) / count(*)) AS share FROM sc2 GROUP BY class_key"
        ),
        "latest_import": q("SELECT arg_max(import_id, created_at) AS import_id FROM (" + _store_sql() + ")"),
        "referential_audit": q("").rstrip() + UNCHECKED + (
            "SELECT 'matched_product_id' AS kind, f.submission_id, f.matched_product_id AS ref FROM unchecked f "
            "WHERE f.matched_product_id IS NOT NULL AND f.matched_product_id NOT IN (SELECT product_id FROM cat) "
            "UNION ALL SELECT 'duplicate_of', f.submission_id, f.duplicate_of FROM unchecked f "
            "WHERE f.duplicate_of IS NOT NULL AND f.duplicate_of NOT IN (SELECT submission_id FROM unchecked)"
        ),
        "drop_import": q(
            "SELECT 'rows' AS kind, 'import-0001' AS import_id, count(*) AS n FROM fin "
            "UNION ALL SELECT 'ids', 'import-0001', count(*) FROM fin "
            "UNION ALL SELECT 'answers', 'import-0001', count(DISTINCT fingerprint) FROM fin WHERE llm_output IS NOT NULL"
        ),
        "revert_import": q(
            "SELECT import_id, status, count(*) AS n FROM (" + _store_sql() + ") WHERE import_id <> 'import-0000' GROUP BY ALL"
        ),
        "drift_by_import": q(_drift_sql()),
        "confidence_shift": q(_shift_sql()),
        "spend_estimate": q(_spend_sql()),
        "cache_table": q(
            f"SELECT '{MODEL}' AS llm_model, '{S.PROMPT_VERSION}' AS llm_prompt_version, fingerprint, cached_output AS llm_output "
            "FROM cache WHERE cached_output IS NOT NULL "
            f"UNION ALL SELECT '{MODEL}', '{S.PROMPT_VERSION}', fingerprint, llm_output FROM ans "
            "WHERE llm_output IS NOT NULL AND d2 NOT IN ('0','2','4','6','8','a','c','e') "
            f"UNION ALL SELECT '{MODEL}', '{S.OLD_PROMPT_VERSION}', fingerprint, {_json('(b + 3) % 16', 'cand')} "
            "FROM (SELECT DISTINCT fingerprint, b, cand FROM un WHERE d2 = '0') WHERE (b + 3) % 16 <> 15"
        ),
        "near_duplicate_summary": q(
            "SELECT count(DISTINCT duplicate_of) AS clusters, count(*) AS demoted FROM fin WHERE status = 'near_duplicate'"
        ),
        "constraint_audit": q(
            "SELECT 'catalog_primary_key' AS \"check\", count(*) AS n FROM "
            "(SELECT product_id FROM cat GROUP BY product_id HAVING count(*) > 1) "
            "UNION ALL SELECT 'catalog_unique_name_producer_size', count(*) FROM "
            "(SELECT 1 FROM cat GROUP BY canonical_name, producer, size_ml HAVING count(*) > 1) "
            f"UNION ALL SELECT 'catalog_domains', count(*) FROM cat WHERE category NOT IN ({_CATS}) "
            f"OR size_ml NOT IN ({_SIZE_LIST}) OR product_id IS NULL OR canonical_name IS NULL OR producer IS NULL "
            "UNION ALL SELECT 'submission_domains', count(*) FROM fin WHERE status NOT IN ("
            + ", ".join(f"'{x}'" for x in S.STATUSES) + ") OR (decision IS NOT NULL AND decision NOT IN ("
            + ", ".join(f"'{x}'" for x in S.DECISIONS) + ")) OR (llm_confidence IS NOT NULL AND "
            "(llm_confidence < 0 OR llm_confidence > 1)) "
            "UNION ALL SELECT 'references', (SELECT count(*) FROM fin WHERE matched_product_id IS NOT NULL AND "
            "matched_product_id NOT IN (SELECT product_id FROM cat)) + (SELECT count(*) FROM fin WHERE duplicate_of "
            "IS NOT NULL AND duplicate_of NOT IN (SELECT submission_id FROM fin))"
        ),
        "request_system_text": q(
            "SELECT NULL AS block_producer, " + _sql_str(R.SYSTEM_HEAD) + " AS line UNION ALL "
            "SELECT lower(canonical), canonical || ' is also called ' || alias FROM ("
            f"SELECT alias, canonical FROM (VALUES {_ALIASES}) v(alias, canonical) UNION ALL "
            "SELECT lower(replace(p_brand, '#', ' no ')), p_brand FROM (SELECT DISTINCT p_brand FROM part))"
        ),
        "request_context": "WITH " + CHAIN.strip().split("\n),\nli AS")[0] + "\n)\n"
        "SELECT lower(producer) AS block_producer, category, product_id, "
        "product_id || ': ' || producer || ' / ' || canonical_name || ' (' || category || ', ' || CAST(size_ml AS VARCHAR) "
        "|| ' ml' || CASE WHEN vintage_required THEN ', needs vintage' ELSE '' END || ')' AS line FROM cat",
        "catalog_list": "WITH " + CHAIN.strip().split("\n),\nli AS")[0] + "\n)\n"
        "SELECT product_id, canonical_name, producer, category, size_ml, vintage_required FROM cat",
        "json_catalog": "WITH " + CHAIN.strip().split("\n),\nli AS")[0] + "\n)\n"
        "SELECT product_id, canonical_name, producer, category, size_ml, vintage_required FROM cat",
        "json_labels": q(
            "SELECT submission_id, expected_product_id, array_to_string(acceptable_decisions, ', ') AS acceptable, "
            "'variant ' || CAST(k AS VARCHAR) AS notes FROM lab JOIN kept USING (submission_id)"
        ),
        "catalog_append": "WITH " + CHAIN.strip().split("\n),\nli AS")[0] + "\n)\n" + _append_sql(),
        "stored_import": q(
            "SELECT 'import-0001' AS import_id, submission_id, status, matched_product_id, duplicate_of FROM fin"
        ),
        "stored_ids": q("SELECT submission_id FROM fin WHERE status <> 'invalid'"),
        "stored_answers": q("SELECT fingerprint, cached_output FROM cache WHERE cached_output IS NOT NULL"),
        "exact_duplicate_summary_rerun": q(
            "SELECT count(*) AS clusters, coalesce(CAST(sum(n) AS BIGINT), 0) - count(*) AS demoted FROM "
            "(SELECT count(*) AS n FROM dd WHERE status = 'pending' GROUP BY fingerprint HAVING count(*) > 1)"
        ),
        "json_variant_import": q(_json_import_sql()),
        "json_array_import": q(
            "SELECT submission_id, status, validation_error, 1 AS n FROM (" + _json_import_sql() + ") "
            "UNION ALL SELECT submission_id, 'missing_id', NULL, count(*) FROM raw WHERE submission_id IS NULL OR submission_id = '' GROUP BY 1 "
            "UNION ALL SELECT submission_id, 'duplicate_id', NULL, count(*) - 1 FROM raw WHERE submission_id <> '' GROUP BY 1 HAVING count(*) > 1 "
            "UNION ALL SELECT NULL, 'invalid_record', NULL, count(*) FROM raw WHERE right(submission_id, 1) = '7' HAVING count(*) > 0"
        ),
        "json_raw_records": q(f"SELECT submission_id, {_record_sql()} AS raw_json FROM kept"),
        "json_rejected_records": q(
            f"SELECT 'missing_id' AS reason, {_record_sql()} AS raw_json FROM raw WHERE submission_id IS NULL OR submission_id = '' "
            "UNION ALL SELECT 'invalid_record', '{\"submission_id\":\"' || submission_id || '\",\"name\":' FROM raw "
            "WHERE right(submission_id, 1) = '7'"
        ),
        "json_import_summary": q(
            "SELECT 'total' AS metric, count(*) + count(*) FILTER (WHERE right(submission_id, 1) = '7') AS value FROM raw UNION ALL "
            "SELECT 'skipped_invalid_record', count(*) FROM raw WHERE right(submission_id, 1) = '7' UNION ALL "
            "SELECT 'skipped_missing_id', count(*) FROM raw WHERE submission_id IS NULL OR submission_id = '' UNION ALL "
            "SELECT 'skipped_invalid_id', 0 UNION ALL "
            "SELECT 'skipped_duplicate_id', count(*) - count(DISTINCT submission_id) FROM raw WHERE submission_id <> '' UNION ALL "
            "SELECT 'with_id', count(*) FROM raw WHERE submission_id <> '' UNION ALL SELECT 'inserted', count(*) FROM kept"
        ),
        "stream_import": "WITH " + CHAIN.strip() + ",\n" + _stream_ctes() + _STREAM_SELECT,
        "stream_status_counts": "WITH " + CHAIN.strip() + ",\n" + _stream_ctes() + _STREAM_SELECT,
        "resolver_hook": q(
            "SELECT submission_id, "
            "CASE WHEN vintage IS NOT NULL AND size_ml >= 1000 THEN 'no_match' ELSE 'review' END AS status, "
            "CASE WHEN vintage IS NOT NULL AND size_ml >= 1000 THEN 'no_match' ELSE 'human_review' END AS decision, "
            "CAST(NULL AS VARCHAR) AS matched_product_id, "
            f"CASE WHEN vintage IS NULL THEN '{S.LLM_UNAVAILABLE}' WHEN size_ml >= 1000 THEN '{S.LLM_NO_MATCH}' "
            f"ELSE '{S.LLM_HUMAN_REVIEW}' END AS explanation, "
            "CASE WHEN vintage IS NULL THEN 'TimeoutError: resolver timed out' WHEN size_ml >= 1000 THEN 'large format' "
            "ELSE 'no candidate named' END AS llm_reason, "
            "CASE WHEN vintage IS NULL THEN NULL WHEN size_ml >= 1000 THEN 0.6 ELSE 0.9 END AS llm_confidence "
            "FROM st1 WHERE status = 'unmatched'"
        ),
        "documents_exact_duplicates": (
            "SELECT sha256(text) AS fingerprint, count(*) AS n, min(doc_id) AS survivor FROM documents "
            "WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
        ),
    }


def _append_sql() -> str:
    """Catalog loads step by step: products with an odd last digit, the others, these again, the odd
    ones instead of all, and the catalog whole, with the names it repeats."""
    key = "canonical_name, producer, size_ml"
    repeated = f"repeated ({key})"
    return f""", single AS (SELECT CAST(right(min(product_id), 1) AS INT) % 2 = 1 AS odd FROM cat GROUP BY {key}),
    tally AS (SELECT count(*) FILTER (WHERE odd) AS odd, count(*) FILTER (WHERE NOT odd) AS even FROM single),
    whole AS (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT 1 FROM cat GROUP BY {key} HAVING count(*) > 1)) AS bad FROM cat)
    SELECT 'load' AS step, 'stored' AS what, odd AS n FROM tally
    UNION ALL SELECT 'append', 'stored', odd + even FROM tally
    UNION ALL SELECT 'append again', 'repeated product_id', even FROM tally
    UNION ALL SELECT 'append again', '{repeated}', even FROM tally
    UNION ALL SELECT 'reload', 'stored', odd FROM tally
    UNION ALL SELECT 'with repeats', CASE WHEN bad > 0 THEN '{repeated}' ELSE 'stored' END, CASE WHEN bad > 0 THEN bad ELSE n END FROM whole"""


def _report_sql() -> str:
    rows = [
        ("input", "records read", "(SELECT count(*) FROM raw)"),
        ("input", "without a usable id", "(SELECT count(*) FROM raw WHERE submission_id IS NULL OR submission_id = '')"),
        ("input", "repeated ids", "(SELECT count(*) FROM skipped)"),
        ("input", "kept", "(SELECT count(*) FROM kept)"),
        ("checks", "failed", "(SELECT count(*) FROM fin WHERE status = 'invalid')"),
        ("checks", "passed", "(SELECT count(*) FROM fin WHERE status <> 'invalid')"),
        ("copies", "demoted", "(SELECT count(*) FROM fin WHERE status = 'exact_duplicate')"),
        ("copies", "groups", "(SELECT count(DISTINCT duplicate_of) FROM fin WHERE status = 'exact_duplicate')"),
        ("copies", "left to match", "(SELECT count(*) FROM t1)"),
        ("rules", "rows", "(SELECT count(*) FROM t1)"),
        ("rules", "exact", "(SELECT count(*) FROM t1 WHERE status = 'matched')"),
        ("rules", "for review", "(SELECT count(*) FROM t1 WHERE status = 'review')"),
        ("rules", "rejected", "(SELECT count(*) FROM t1 WHERE status = 'no_match')"),
        ("rules", "undecided", "(SELECT count(*) FROM t1 WHERE status = 'unmatched')"),
        ("model", "rows", "(SELECT count(*) FROM t2)"),
        ("model", "from the cache", "(SELECT count(*) FROM t2 WHERE llm_source = 'cache')"),
        ("model", "failed calls", "(SELECT count(*) FROM t2 WHERE llm_source = 'error')"),
        ("model", "accepted", f"(SELECT count(*) FROM t2 WHERE explanation = '{S.LLM_POSSIBLE_MATCH}')"),
        ("model", "for review", f"(SELECT count(*) FROM t2 WHERE explanation IN ('{S.LLM_HUMAN_REVIEW}', '{S.LLM_UNAVAILABLE}'))"),
        ("model", "rejected", f"(SELECT count(*) FROM t2 WHERE explanation = '{S.LLM_NO_MATCH}')"),
        ("products", "demoted", "(SELECT count(*) FROM fin WHERE status = 'near_duplicate')"),
        ("products", "groups", "(SELECT count(DISTINCT duplicate_of) FROM fin WHERE status = 'near_duplicate')"),
    ]
    rows += [("status", s, f"(SELECT count(*) FROM fin WHERE status = '{s}')") for s in S.STATUSES]
    rows += [("status", "all", "(SELECT count(*) FROM fin)")]
    return " UNION ALL ".join(
        f"SELECT '{sec}' AS section, '{m}' AS metric, CAST({v} AS BIGINT) AS value" for sec, m, v in rows
    )


def _inspect_sql() -> str:
    return (
        "SELECT submission_id AS id, left(coalesce(producer, ''), 20) AS producer, left(coalesce(name, ''), 35) AS name, "
        "category, vintage AS vint, size_ml AS ml, status, decision, matched_product_id AS matched, "
        "CAST(round(CAST(llm_confidence AS DECIMAL(10,4)), 2) AS DOUBLE) AS conf, "
        "left(coalesce(explanation, llm_reason, validation_error, ''), 40) AS why, "
        f"{_status_order('status')} AS status_order FROM fin"
    )


def _store_sql() -> str:
    """The stored rows of both imports: import_id, created_at, status."""
    parts = []
    for shift, digits in ((1, "02468ace"), (2, "02468ace"), (3, "0")):
        dl = ", ".join(f"'{d}'" for d in digits)
        parts.append(
            "SELECT 'import-0000' AS import_id, TIMESTAMP '2025-01-01' AS created_at, 'answered' AS status "
            f"FROM (SELECT DISTINCT fingerprint, b, {shift} AS s FROM un WHERE d2 IN ({dl}))"
        )
    return " UNION ALL ".join([*parts, "SELECT 'import-0001', TIMESTAMP '2026-01-01', status FROM fin"])


_NO_BLOCK = (
    "FROM t1 WHERE status = 'unmatched' "
    "AND NOT EXISTS (SELECT 1 FROM cat c WHERE lower(c.producer) = t1.pk AND c.category = t1.category)"
)


def _search_sql() -> str:
    """Products for rows whose producer has no block: all that share a rare token of the row's
    producer and name (or, without one, a rarest known token), with the weight of what they share."""
    words = norm("producer || ' ' || name")
    held = norm("producer || ' ' || canonical_name")
    posting = f"SELECT product_id, category, unnest({toks(held)}) AS token FROM cat"
    freq = (
        "SELECT f.category, f.token, f.df, CAST(round(ln(1 + n.products / f.df) * 1e6) AS BIGINT) AS weight, "
        f"f.df <= {R.RARE_PRODUCTS} AND f.df * {R.RARE_ONE_IN} <= n.products AS rare "
        f"FROM (SELECT category, token, count(*) AS df FROM ({posting}) GROUP BY 1, 2) f "
        "JOIN (SELECT category, count(*) AS products FROM cat GROUP BY 1) n USING (category)"
    )
    known = (
        "SELECT w.submission_id, w.category, w.token, f.weight, f.rare OR f.df = min(f.df) OVER (PARTITION BY w.submission_id) AS asked "
        f"FROM (SELECT submission_id, category, unnest({toks(words)}) AS token {_NO_BLOCK}) w "
        f"JOIN ({freq}) f ON f.category = w.category AND f.token = w.token"
    )
    return (
        "SELECT submission_id, product_id, shared, weight, rank() OVER (PARTITION BY submission_id ORDER BY weight DESC) AS rank "
        "FROM (SELECT k.submission_id, p.product_id, count(*) AS shared, CAST(sum(k.weight) AS BIGINT) AS weight "
        f"FROM ({known}) k JOIN ({posting}) p ON p.category = k.category AND p.token = k.token "
        "GROUP BY 1, 2 HAVING bool_or(k.asked))"
    )


def _near_sql() -> str:
    """Blocks of a producer within two edits, for rows whose producer has none."""
    return (
        "SELECT r.submission_id, r.category, b.block_producer, levenshtein(r.name, b.name) AS distance, b.block_products "
        f"FROM (SELECT submission_id, category, {norm('pk')} AS name {_NO_BLOCK}) r "
        f"JOIN (SELECT lower(producer) AS block_producer, category, {norm('any_value(producer)')} AS name, count(*) AS block_products "
        "FROM cat GROUP BY 1, 2) b ON b.category = r.category "
        f"WHERE levenshtein(r.name, b.name) <= {R.PRODUCER_EDITS}"
    )


def _record_sql() -> str:
    """A record's JSON text, by the last character of its id (see the JSON writer)."""
    h = "right(coalesce(submission_id, ''), 1)"
    text = lambda c: f"'\"' || {c} || '\"'"
    vintage = (
        f"CASE {h} WHEN '1' THEN {text('CAST(vintage AS VARCHAR)')} WHEN '2' THEN CAST(vintage AS VARCHAR) || '.5' "
        "WHEN '5' THEN '1.0E30' WHEN '6' THEN '\"99999999999999999999\"' ELSE CAST(vintage AS VARCHAR) END"
    )
    parts = [
        f"CASE WHEN submission_id IS NOT NULL THEN '\"submission_id\":' || {text('submission_id')} END",
        f"'\"name\":' || CASE {h} WHEN '4' THEN 'true' ELSE {text('name')} END",
        f"CASE WHEN producer IS NOT NULL THEN '\"producer\":' || {text('producer')} END",
        f"'\"category\":' || {text('category')}",
        f"CASE WHEN vintage IS NOT NULL THEN '\"vintage\":' || {vintage} END",
        f"'\"size_ml\":' || CAST(size_ml AS VARCHAR) || CASE {h} WHEN '3' THEN '.0' ELSE '' END",
        f"CASE {h} WHEN '7' THEN '\"partner_sku\":\"SKU of ' || submission_id || '\"' END",
    ]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _misses_sql() -> str:
    return (
        "SELECT submission_id, 'record' AS kind, CAST(NULL AS VARCHAR) AS expected, CAST(NULL AS VARCHAR) AS got FROM sc2 WHERE NOT found "
        "UNION ALL SELECT submission_id, 'status', 'invalid', status FROM sc2 WHERE found AND by_status AND NOT correct "
        "UNION ALL SELECT submission_id, 'product', expected_product_id, matched_product_id "
        "FROM sc2 WHERE found AND NOT by_status AND NOT pid_correct "
        "UNION ALL SELECT submission_id, 'decision', array_to_string(list_sort(acceptable_decisions), ' or '), decision "
        "FROM sc2 WHERE found AND NOT by_status AND NOT decision_correct"
    )


_STREAM_SELECT = """
SELECT CASE WHEN d = 1 THEN 'stream-000000' ELSE 'stream-000001' END AS import_id, status, count(*) AS n
FROM (SELECT d, status FROM xd WHERE status <> 'pending' UNION ALL SELECT d, status FROM xt2 WHERE status <> 'matched'
      UNION ALL SELECT d, CASE WHEN submission_id = min(submission_id) OVER (PARTITION BY d, pid) THEN 'matched'
                               ELSE 'near_duplicate' END FROM xt2 WHERE status = 'matched')
GROUP BY 1, 2
"""


def _stream_ctes() -> str:
    """Two deliveries (even or missing vintage first), each one import of JSON records:
    first-wins per id inside a delivery, ids of the first delivery skipped in the second,
    JSON typing rules by the id's last character, dedup, tier 1, tier 2 by the fingerprint rule (a
    cached answer equals a fresh one) and the sweep per import."""
    return f"""
xraw AS (SELECT *, CASE WHEN coalesce(vintage, 0) % 2 = 0 THEN 1 ELSE 2 END AS d FROM raw),
xr AS (
  SELECT *, row_number() OVER (PARTITION BY d, submission_id
            ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS rn
  FROM xraw WHERE submission_id IS NOT NULL AND submission_id <> ''
),
xk AS (
  SELECT * FROM xr WHERE rn = 1 AND NOT (d = 2 AND submission_id IN (SELECT submission_id FROM xr WHERE d = 1))
),
xc AS (SELECT *, {trim_u('name')} AS t_name, {trim_u('producer')} AS t_producer, {trim_u('category')} AS t_category FROM xk),
xe AS (
  SELECT *,
    CASE WHEN right(submission_id, 1) = '4' THEN '{S.MSG_STRING_TYPE}' WHEN name IS NULL THEN '{S.MSG_REQUIRED}'
         WHEN length(t_name) = 0 THEN '{S.MSG_STRING_EMPTY}' END AS e_name,
    CASE WHEN producer IS NULL THEN '{S.MSG_REQUIRED}' WHEN length(t_producer) = 0 THEN '{S.MSG_STRING_EMPTY}' END AS e_producer,
    CASE WHEN category IS NULL THEN '{S.MSG_REQUIRED}' WHEN length(t_category) = 0 THEN '{S.MSG_STRING_EMPTY}' END AS e_category,
    CASE WHEN right(submission_id, 1) = '2' AND vintage IS NOT NULL THEN '{S.MSG_INT_FRACTION}'
         WHEN right(submission_id, 1) IN ('5', '6') AND vintage IS NOT NULL THEN '{S.msg_vintage_high()}'
         WHEN vintage < {S.VINTAGE_MIN} THEN '{S.msg_vintage_low()}'
         WHEN vintage > {S.VINTAGE_MAX} THEN '{S.msg_vintage_high()}' END AS e_vintage,
    CASE WHEN size_ml IS NULL THEN '{S.MSG_REQUIRED}' WHEN size_ml NOT IN ({_SIZE_LIST}) THEN '{S.MSG_SIZE}' END AS e_size
  FROM xc
),
xv AS (
  SELECT submission_id, d,
    CASE WHEN e_name IS NULL THEN t_name END AS name,
    CASE WHEN e_producer IS NULL THEN t_producer END AS producer,
    CASE WHEN e_category IS NULL THEN t_category END AS category,
    CASE WHEN e_vintage IS NULL THEN vintage END AS vintage,
    CASE WHEN e_size IS NULL THEN size_ml END AS size_ml,
    NULLIF(concat_ws('; ', 'name: ' || e_name, 'producer: ' || e_producer, 'category: ' || e_category,
                     'vintage: ' || e_vintage, 'size_ml: ' || e_size), '') AS validation_error
  FROM xe
),
xv2 AS (
  SELECT *, CASE WHEN validation_error IS NULL THEN 'pending' ELSE 'invalid' END AS status0,
    CASE WHEN validation_error IS NULL THEN
      sha256(concat_ws('|', name, producer, category, coalesce(CAST(vintage AS VARCHAR), ''), CAST(size_ml AS VARCHAR)))
    END AS fingerprint
  FROM xv
),
xd0 AS (
  SELECT *, min(submission_id) OVER (PARTITION BY d, fingerprint) AS surv,
         count(*) OVER (PARTITION BY d, fingerprint) AS fcnt
  FROM xv2
),
xd AS (
  SELECT * EXCLUDE (surv, fcnt, status0),
    CASE WHEN fingerprint IS NOT NULL AND fcnt > 1 AND submission_id <> surv THEN 'exact_duplicate' ELSE status0 END AS status
  FROM xd0
),
xp AS (
  SELECT x.*, lower(coalesce(al.canonical, x.producer)) AS pk, {norm('x.name')} AS norm
  FROM xd x LEFT JOIN al ON al.alias_key = lower({trim_u('x.producer')})
  WHERE x.status = 'pending'
),
xpt AS (SELECT *, {toks('norm')} AS s_tokens, category IN ({_CATS}) AS in_scope FROM xp),
xpairs AS (
  SELECT p.submission_id, c.product_id, c.p_size = p.size_ml AS at_size, c.vintage_required
  FROM xpt p JOIN ctok c ON c.pk = p.pk AND c.category = p.category AND list_has_all(c.p_tokens, p.s_tokens)
  WHERE p.in_scope
),
xcnt AS (
  SELECT submission_id, count(*) FILTER (WHERE at_size) AS n_at_size, count(*) AS n_any,
         min(product_id) FILTER (WHERE at_size) AS first_pid,
         arg_min(vintage_required, product_id) FILTER (WHERE at_size) AS first_vreq
  FROM xpairs GROUP BY submission_id
),
xt1 AS (
  SELECT p.d, p.submission_id, p.fingerprint, p.producer, p.category, c.first_pid,
    CASE WHEN NOT p.in_scope THEN 'no_match'
         WHEN coalesce(c.n_at_size, 0) = 1 AND coalesce(c.first_vreq, false) AND p.vintage IS NULL THEN 'review'
         WHEN coalesce(c.n_at_size, 0) = 1 THEN 'matched' WHEN coalesce(c.n_at_size, 0) > 1 THEN 'review'
         WHEN coalesce(c.n_any, 0) = 1 THEN 'no_match' ELSE 'unmatched' END AS status
  FROM xpt p LEFT JOIN xcnt c USING (submission_id)
),
xa AS (
  SELECT x.*, strpos('0123456789abcdef', substr(x.fingerprint, 1, 1)) - 1 AS b,
         {_CAND.format(fp='x.fingerprint', cand='blk.cand')} AS named
  FROM xt1 x LEFT JOIN blk ON blk.bpk = lower(x.producer) AND blk.bcat = x.category
),
xt2 AS (
  SELECT d, submission_id, CASE WHEN status = 'unmatched' THEN named ELSE first_pid END AS pid,
    CASE WHEN status <> 'unmatched' THEN status WHEN b = 15 THEN 'review'
         WHEN ({_DECISIONS})[b % 4 + 1] = 'no_match' THEN 'no_match'
         WHEN ({_DECISIONS})[b % 4 + 1] = 'human_review' OR (b + 4) / 20.0 < {S.AUTO_APPLY_THRESHOLD}
              OR named IS NULL OR named = '{UNKNOWN_PRODUCT}' THEN 'review' ELSE 'matched' END AS status
  FROM xa
)
"""


def _json_import_sql() -> str:
    """The JSON/VARIANT import: ids ending in 2 carry fractional vintages, in 4 a boolean name."""
    return f"""
    SELECT submission_id, CASE WHEN verr IS NULL THEN 'pending' ELSE 'invalid' END AS status, verr AS validation_error,
           CASE WHEN jn IS NULL THEN t_name END AS name,
           CASE WHEN jv IS NULL THEN vintage END AS vintage,
           CASE WHEN e_size IS NULL THEN size_ml END AS size_ml
    FROM (
      SELECT *, NULLIF(concat_ws('; ', 'name: ' || jn, 'producer: ' || e_producer, 'category: ' || e_category,
                       'vintage: ' || jv, 'size_ml: ' || e_size), '') AS verr
      FROM (
        SELECT *,
          CASE WHEN right(submission_id, 1) = '4' THEN '{S.MSG_STRING_TYPE}' ELSE e_name END AS jn,
          CASE WHEN right(submission_id, 1) = '2' AND vintage IS NOT NULL THEN '{S.MSG_INT_FRACTION}'
               WHEN right(submission_id, 1) IN ('5', '6') AND vintage IS NOT NULL THEN '{S.msg_vintage_high()}'
               ELSE e_vintage END AS jv
        FROM errs))
    """


def _spend_sql() -> str:
    """Per import: submissions, rows settled without the model, model calls, estimated spend."""
    hist = []
    for shift, digits in ((1, "02468ace"), (2, "02468ace"), (3, "0")):
        dl = ", ".join(f"'{d}'" for d in digits)
        hist.append(
            f"SELECT CASE WHEN (b + {shift}) % 16 = 15 THEN 'error' ELSE 'model' END AS llm_source "
            f"FROM (SELECT DISTINCT fingerprint, b FROM un WHERE d2 IN ({dl}))"
        )
    return (
        "SELECT import_id, count(*) AS submissions, count(*) FILTER (WHERE llm_source IS NULL) AS deterministic, "
        "count(*) FILTER (WHERE llm_source IN ('model', 'error')) AS model_calls, "
        "CAST(round(count(*) FILTER (WHERE llm_source IN ('model', 'error')) * CAST('0.00375' AS DECIMAL(12,10)), 4) AS DOUBLE) "
        "AS est_usd FROM ("
        "SELECT 'import-0000' AS import_id, llm_source FROM (" + " UNION ALL ".join(hist) + ") "
        "UNION ALL SELECT 'import-0001', llm_source FROM fin) GROUP BY import_id"
    )


def _drift_rows() -> str:
    """History import (three answer sets) and this import: decision and confidence of each row."""
    hist_parts = []
    for shift, digits, version in ((1, "02468ace", "new"), (2, "02468ace", "new"), (3, "0", "old")):
        dl = ", ".join(f"'{d}'" for d in digits)
        b = f"(b + {shift}) % 16"
        hist_parts.append(
            f"SELECT {b} AS hb, cand FROM (SELECT DISTINCT fingerprint, b, cand FROM un WHERE d2 IN ({dl}))"
        )
    h = " UNION ALL ".join(hist_parts)
    hdec = (
        f"CASE WHEN hb = 15 THEN 'human_review' WHEN ({_DECISIONS})[hb % 4 + 1] = 'no_match' THEN 'no_match' "
        f"WHEN ({_DECISIONS})[hb % 4 + 1] = 'human_review' OR CAST(CAST((hb + 4) / 20.0 AS DECIMAL(3,2)) AS DOUBLE) "
        f"< {S.AUTO_APPLY_THRESHOLD} OR cand IS NULL OR cand = '{UNKNOWN_PRODUCT}' THEN 'human_review' ELSE 'possible_match' END"
    )
    hconf = "CASE WHEN hb = 15 THEN NULL ELSE CAST(CAST((hb + 4) / 20.0 AS DECIMAL(3,2)) AS DOUBLE) END"
    return (
        f"SELECT 'import-0000' AS import_id, {hdec} AS decision, {hconf} AS llm_confidence FROM ({h}) "
        f"UNION ALL SELECT 'import-0001', decision, llm_confidence FROM fin"
    )


def _drift_sql() -> str:
    return f"SELECT import_id, decision, count(*) AS n, round(avg(llm_confidence), 4) AS avg_confidence FROM ({_drift_rows()}) GROUP BY import_id, decision"


def _shift_sql() -> str:
    """Population stability index of the confidences, twenty bins, from import to import."""
    counts = f"SELECT import_id, least(CAST(floor(llm_confidence * 20) AS INTEGER), 19) AS bin, count(*) AS n FROM ({_drift_rows()}) WHERE llm_confidence IS NOT NULL GROUP BY 1, 2"
    grid = f"SELECT i.import_id, g.bin FROM (SELECT DISTINCT import_id FROM ({counts})) i, (SELECT unnest(range(20)) AS bin) g"
    shares = (
        "SELECT g.import_id, g.bin, coalesce(c.n, 0) AS n, (coalesce(c.n, 0) + 0.5) / CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY g.import_id) + 10 AS DOUBLE) AS p "
        f"FROM ({grid}) g LEFT JOIN ({counts}) c ON c.import_id = g.import_id AND c.bin = g.bin"
    )
    return (
        "SELECT import_id, CAST(sum(n) AS BIGINT) AS n, round(sum((p - q) * ln(p / q)), 6) AS psi "
        f"FROM (SELECT *, lag(p) OVER (PARTITION BY bin ORDER BY import_id) AS q FROM ({shares})) GROUP BY import_id"
    )
