"""Schemas, domains and fixed values.

FIXED VALUES (they must equal the matching engine's published rules for right
results; kept here together, in their natural order):

- catalog categories: Wine, Whisky, Bourbon, Tequila, Rum, Cognac
- allowed bottle sizes (ml): 50, 100, 200, 375, 500, 700, 750, 1000, 1500, 3000, 6000
- vintage range: 1800 .. 2026 (inclusive; the upper bound is a parameter)
- submission statuses, in declaration order: pending, invalid, exact_duplicate,
  near_duplicate, matched, review, no_match, unmatched
- decisions: exact_match, possible_match, human_review, no_match
- tier-1 reasons: category_mismatch, vintage_required_missing, size_ml_mismatch, multiple_candidates
- tier-2 reasons: llm_possible_match, llm_no_match, llm_human_review, llm_unavailable
- model decision classes: exact_match, possible_match, no_match, human_review
- auto-apply confidence threshold: 0.85
- producer aliases (alias, lower-case and trimmed -> canonical producer):
    macallan -> The Macallan
    suntory hibiki -> Suntory
    old rip van winkle distillery -> Old Rip Van Winkle
    van winkle -> Old Rip Van Winkle
    lafite rothschild -> Chateau Lafite Rothschild
    drc -> Domaine de la Romanee-Conti
- validation messages:
    Field required
    Input should be a valid string
    String should have at least 1 character
    Input should be a valid integer
    Input should be a valid integer, unable to parse string as an integer
    Input should be a valid integer, got a number with a fractional part
    Input should be greater than or equal to 1800
    Input should be less than or equal to 2026
    Input should be 50, 100, 200, 375, 500, 700, 750, 1000, 1500, 3000 or 6000
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (see module docstring) -------------------------------------------------
CATEGORIES = ["Wine", "Whisky", "Bourbon", "Tequila", "Rum", "Cognac"]
SIZES_ML = [50, 100, 200, 375, 500, 700, 750, 1000, 1500, 3000, 6000]
VINTAGE_MIN = 1800
VINTAGE_MAX = 2026

STATUSES = [
    "pending",
    "invalid",
    "exact_duplicate",
    "near_duplicate",
    "matched",
    "review",
    "no_match",
    "unmatched",
]
DECISIONS = ["exact_match", "possible_match", "human_review", "no_match"]
MODEL_DECISIONS = ["exact_match", "possible_match", "no_match", "human_review"]

CATEGORY_MISMATCH = "category_mismatch"
VINTAGE_REQUIRED_MISSING = "vintage_required_missing"
SIZE_ML_MISMATCH = "size_ml_mismatch"
MULTIPLE_CANDIDATES = "multiple_candidates"

LLM_POSSIBLE_MATCH = "llm_possible_match"
LLM_NO_MATCH = "llm_no_match"
LLM_HUMAN_REVIEW = "llm_human_review"
LLM_UNAVAILABLE = "llm_unavailable"

AUTO_APPLY_THRESHOLD = 0.85
#: Version of the request texts below; a change of theirs bumps it, so that stored answers are
#: only served for the texts that produced them.
PROMPT_VERSION = "block-2"
#: An older version, for stored answers that no longer count.
OLD_PROMPT_VERSION = "block-1"
DEFAULT_MODEL = "gemini-2.5-flash"

PRODUCER_ALIASES = [
    ("macallan", "The Macallan"),
    ("suntory hibiki", "Suntory"),
    ("old rip van winkle distillery", "Old Rip Van Winkle"),
    ("van winkle", "Old Rip Van Winkle"),
    ("lafite rothschild", "Chateau Lafite Rothschild"),
    ("drc", "Domaine de la Romanee-Conti"),
]

MSG_REQUIRED = "Field required"
MSG_STRING_TYPE = "Input should be a valid string"
MSG_STRING_EMPTY = "String should have at least 1 character"
MSG_INT_TYPE = "Input should be a valid integer"
MSG_INT_PARSE = "Input should be a valid integer, unable to parse string as an integer"
MSG_INT_FRACTION = "Input should be a valid integer, got a number with a fractional part"
MSG_SIZE = "Input should be 50, 100, 200, 375, 500, 700, 750, 1000, 1500, 3000 or 6000"


def msg_vintage_low(lo: int = VINTAGE_MIN) -> str:
    return f"Input should be greater than or equal to {lo}"


def msg_vintage_high(hi: int = VINTAGE_MAX) -> str:
    return f"Input should be less than or equal to {hi}"


# --- schemas -------------------------------------------------------------------------------
CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("canonical_name", T.StringType(), False),
        T.StructField("producer", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("size_ml", T.IntegerType(), False),
        T.StructField("vintage_required", T.BooleanType(), True),
    ]
)

# Raw submission records with typed fields (a parquet or table source).  A null value
# means the key was absent.  ``position`` is the record's place in its source and decides
# which of several rows with one submission_id is kept.
RAW_SUBMISSION_SCHEMA = T.StructType(
    [
        T.StructField("submission_id", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("producer", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("vintage", T.IntegerType(), True),
        T.StructField("size_ml", T.IntegerType(), True),
    ]
)

# Why a record is not inserted.
SKIP_REASONS = ["invalid_record", "missing_id", "invalid_id", "duplicate_id"]

MODEL_DECISION_SCHEMA = T.StructType(
    [
        T.StructField("decision", T.StringType(), True),
        T.StructField("confidence", T.DoubleType(), True),
        T.StructField("candidate_product_ids", T.ArrayType(T.StringType()), True),
        T.StructField("reason", T.StringType(), True),
    ]
)

# Full stored state of one submission (one row per kept record of an import).
STATE_COLUMNS = [
    "submission_id",
    "import_id",
    "position",
    "name",
    "producer",
    "category",
    "vintage",
    "size_ml",
    "raw_json",
    "status",
    "decision",
    "matched_product_id",
    "explanation",
    "llm_confidence",
    "llm_reason",
    "llm_model",
    "llm_prompt_version",
    "llm_output",
    "validation_error",
    "duplicate_of",
    "fingerprint",
    "tier1_status",
    "llm_source",
    "created_at",
    "updated_at",
]

LABEL_SCHEMA = T.StructType(
    [
        T.StructField("submission_id", T.StringType(), False),
        T.StructField("expected_product_id", T.StringType(), True),
        T.StructField("acceptable_decisions", T.ArrayType(T.StringType()), False),
        T.StructField("notes", T.StringType(), True),
    ]
)
