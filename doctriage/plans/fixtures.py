"""Deterministic inputs derived from the driver tables.

Each fixture is a list of *layers*; a layer is a list of ``(name, sql_expression)``
computed on top of the previous one.  The same expressions are valid in Spark SQL
and DuckDB, so :func:`build` (Spark) and :func:`sql_select` (oracle SQL) construct the
same rows.  Only the *inputs* are shared; every operator under test runs through
the library on the Spark side, and the oracle states the expected answer from the
construction rule.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.extract import by_slices
from ..schemas import OFFERED_TYPES


def _case_list(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


NL = "chr(10)"

# --- requests_fx: one classification request per document -------------------
REQUESTS_LAYERS = [
    [
        ("document_id", "'doc_' || CAST(doc_id AS STRING)"),
        ("ext", _case_list("doc_id % 7", ["pdf", "txt", "md", "docx", "jpg", "TIFF", "html"])),
        ("source_type", "CASE WHEN doc_id % 4 < 2 THEN 's3' WHEN doc_id % 4 = 2 THEN 'local' ELSE 'text' END"),
        ("document_content", "CASE WHEN doc_id % 11 = 0 THEN '' ELSE text END"),
    ],
    [
        ("uri", "CASE source_type "
                   "WHEN 's3' THEN 's3://' || source || '/' || lang || '/doc_' || CAST(doc_id AS STRING) || '.' || ext "
                   "WHEN 'local' THEN '/data/' || source || '/doc_' || CAST(doc_id AS STRING) || '.' || ext "
                   "ELSE 'direct://text-input' END"),
    ],
    [
        ("request_key", "CASE WHEN source_type = 'text' THEN uri || '#' || document_id ELSE uri END"),
    ],
]
REQUESTS_COLUMNS = ["doc_id", "document_id", "source_type", "uri AS source", "request_key", "ext",
                    "document_content", "lang", "n_chars"]

# --- answers_fx: raw scorer answers, twelve shapes by doc_id % 12 --------------
ANSWER_LAYERS = REQUESTS_LAYERS + [
    [
        ("t", _case_list("doc_id % 10", OFFERED_TYPES)),
        ("s_txt", "CASE WHEN n_chars % 101 = 100 THEN '1.00' "
                  "ELSE '0.' || lpad(CAST(n_chars % 101 AS STRING), 2, '0') END"),
        ("s", "CAST(n_chars % 101 AS DOUBLE) / 100"),
        ("shape", "doc_id % 12"),
        ("reason", "CASE WHEN doc_id % 10 = 9 AND doc_id % 3 = 0 THEN 'Text was # Limit text length' "
                   "ELSE 'reason ' || CAST(doc_id AS STRING) END"),
    ],
    [
        ("answer_obj",
         "'{\"predicted_type\": \"' || "
         "(CASE shape WHEN 5 THEN upper(t) WHEN 6 THEN 'spaceship' ELSE t END) || '\", ' || "
         "(CASE shape WHEN 11 THEN '' ELSE '\"confidence_score\": ' || "
         "(CASE shape WHEN 8 THEN '1.5' WHEN 9 THEN '\"' || s_txt || '\"' ELSE s_txt END) || ', ' END) || "
         "'\"reasoning\": \"' || reason || '\", \"extracted_features\": ' || "
         "(CASE shape WHEN 4 THEN '{\"key_terms\": [\"' || t || '\"], \"layout\": {\"pages\": 1}}' "
         "ELSE '{\"key_terms\": [\"' || t || '\"], \"document_structure\": \"prose\"}' END) || '}'"),
    ],
    [
        ("response_text",
         "CASE shape "
         f"WHEN 1 THEN '```json' || {NL} || answer_obj || {NL} || '```' "
         f"WHEN 2 THEN '```' || {NL} || answer_obj || {NL} || '```' "
         "WHEN 3 THEN 'Here is the classification: ' || answer_obj || ' Let me know if you need more.' "
         f"WHEN 4 THEN 'After reading the document carefully:' || {NL} || answer_obj "
         "WHEN 7 THEN 'I cannot classify this.' "
         "WHEN 10 THEN '[' || answer_obj || ']' "
         "ELSE answer_obj END"),
        ("has_answer", "doc_id % 97 <> 0"),
    ],
]

# Expected outcome of each answer, stated from the construction (oracle only).
EXPECTED_LAYERS = ANSWER_LAYERS + [
    [
        ("exp_stage", "CASE WHEN NOT has_answer THEN 'missing' WHEN shape IN (7, 8) THEN 'parse' "
                      "WHEN shape = 10 THEN 'batch' ELSE 'ok' END"),
    ],
    [
        ("exp_status", "CASE WHEN exp_stage IN ('ok', 'parse') THEN 'success' ELSE 'error' END"),
        ("exp_type", "CASE WHEN exp_stage <> 'ok' OR shape = 6 THEN 'unknown' ELSE t END"),
        ("exp_score", "CASE WHEN exp_stage <> 'ok' OR shape = 11 THEN CAST(0.0 AS DOUBLE) ELSE s END"),
        ("exp_reasoning",
         "CASE exp_stage WHEN 'ok' THEN reason "
         "WHEN 'parse' THEN (CASE shape WHEN 7 THEN 'Failed to parse classification response: Could not "
         "extract valid JSON from response: line 1 column 1 (char 0)' ELSE 'Failed to parse classification "
         "response: Primary score must be between 0.0 and 1.0' END) "
         "WHEN 'batch' THEN 'Batch processing failed: ''list'' object has no attribute ''get''' "
         "ELSE 'Batch processing failed: no recorded answer for request ' || request_key END"),
    ],
]

# --- results_fx: batch results over time, from events ---------------------------
RESULTS_LAYERS = [
    [
        ("document_id", "'doc_' || CAST(event_id AS STRING)"),
        ("source", "'s3://bucket' || CAST(user_id % 5 AS STRING) || '/doc_' || CAST(event_id AS STRING) || '.pdf'"),
        ("status", "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'timeout' ELSE 'success' END"),
        ("model", "CASE WHEN user_id % 13 = 0 THEN 'custom-model' WHEN user_id % 3 = 0 THEN 'nova-lite' "
                  "WHEN user_id % 3 = 1 THEN 'claude-haiku' ELSE 'claude-sonnet' END"),
        ("processing_time_ms", "CASE WHEN event_id % 17 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END"),
    ],
    [
        ("document_type", "CASE WHEN status = 'success' THEN " + _case_list("event_id % 10", OFFERED_TYPES)
         + " END"),
        ("confidence", "CASE WHEN status = 'success' THEN CAST(event_id % 101 AS DOUBLE) / 100 END"),
        ("error", "CASE status WHEN 'error' THEN 'Simulated failure for doc_' || CAST(event_id AS STRING) "
                  "WHEN 'timeout' THEN 'Processing timed out after 300 seconds' END"),
    ],
]
RESULTS_COLUMNS = ["event_id", "document_id", "source", "status", "model", "document_type",
                   "confidence", "processing_time_ms", "error", "ts"]


def _apply(df: DataFrame, layers) -> DataFrame:
    for layer in layers:
        df = df.selectExpr("*", *[f"{expr} AS {name}" for name, expr in layer])
    return df


def build(spark: SparkSession, sf_dir: str, table: str, layers, columns=None) -> DataFrame:
    df = _apply(spark.read.parquet(f"{sf_dir}/{table}.parquet"), layers)
    return df.selectExpr(*columns) if columns else df


def sql_select(table: str, layers, columns=None) -> str:
    """Nested SELECT building the same rows in DuckDB."""
    q = f"SELECT * FROM {table}"
    for layer in layers:
        exprs = ", ".join(f"{expr} AS {name}" for name, expr in layer)
        q = f"SELECT *, {exprs} FROM ({q})"
    if columns:
        q = f"SELECT {', '.join(columns)} FROM ({q})"
    return q


def requests_fx(spark, sf_dir):
    return build(spark, sf_dir, "documents", REQUESTS_LAYERS, REQUESTS_COLUMNS)


def answers_fx(spark, sf_dir):
    """Recorded answers keyed by ``request_key``; every 97th document has none."""
    return (build(spark, sf_dir, "documents", ANSWER_LAYERS)
            .where("has_answer").select("request_key", "response_text"))


_RECORDED: dict[tuple[str, str], object] = {}


def recorded(spark, sf_dir):
    """The scorer of the recorded answers; they are stored once a session, not once a query."""
    from ..operators.score import recorded_scorer

    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _RECORDED:
        _RECORDED[at] = recorded_scorer(answers_fx(spark, sf_dir), materialize_answers=True)
    return _RECORDED[at]


def recorded_with_expectations(spark, sf_dir):
    """As ``recorded``, with each request's expected type and score ceiling in the same stored table."""
    from ..operators.score import recorded_scorer

    at = (spark.sparkContext.applicationId, sf_dir + "#expected")
    if at not in _RECORDED:
        rows = build(spark, sf_dir, "documents", ANSWER_LAYERS).selectExpr(
            "request_key", "CASE WHEN has_answer THEN response_text END AS response_text", "t AS expected_type",
            "CAST(0.8 AS DOUBLE) AS score_ceiling")
        _RECORDED[at] = recorded_scorer(rows, materialize_answers=True, carry=["expected_type", "score_ceiling"])
    return _RECORDED[at]


def results_fx(spark, sf_dir):
    df = build(spark, sf_dir, "events", RESULTS_LAYERS, RESULTS_COLUMNS)
    # the naive event time is a UTC wall clock, whatever the session time zone
    as_utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), df["ts"].cast("timestamp_ntz"))
    return df.withColumn("timestamp", as_utc.cast("timestamp")).drop("ts")


def requests_sql():
    return sql_select("documents", REQUESTS_LAYERS, REQUESTS_COLUMNS)


def expected_sql():
    return sql_select("documents", EXPECTED_LAYERS)


def results_sql():
    return (f"SELECT * EXCLUDE (ts), ts AS timestamp FROM "
            f"({sql_select('events', RESULTS_LAYERS, RESULTS_COLUMNS)})")


# --- lexicon_fx: language stop words as evidence (for the offline scorer) --------
LANGUAGE_LEXICON = {
    "en": ["the", "of", "and", "to", "that", "with"],
    "fr": ["le", "et", "les", "des", "ou", "qui"],
    "de": ["der", "die", "und", "den", "zu", "von"],
    "es": ["el", "los", "del", "se", "ci", "por"],
}
LEXICON_ROWS = [(lang, term, 1.0) for lang, terms in LANGUAGE_LEXICON.items() for term in terms]


def lexicon_fx(spark):
    return spark.createDataFrame(LEXICON_ROWS, "document_type string, term string, weight double")


def docx_bytes(text: str) -> bytes:
    """A minimal DOCX whose body paragraphs are the lines of ``text`` (fixture builder)."""
    import io
    import zipfile
    from xml.sax.saxutils import escape

    def clean(s):  # characters XML 1.0 cannot carry
        return "".join(ch for ch in s if ch in "\t\n\r" or ord(ch) >= 0x20)

    paras = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(clean(line))}</w:t></w:r></w:p>'
                    for line in text.split("\n"))
    doc = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
           '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main">'
           f"<w:body>{paras}</w:body></w:document>")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0" encoding="UTF-8"?><Types '
                   'xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        z.writestr("word/document.xml", doc)
    return buf.getvalue()


@F.arrow_udf(T.BinaryType())
def make_docx(texts: pa.Array) -> pa.Array:
    """DOCX bytes for each text (Arrow-batched fixture builder)."""
    return by_slices(texts, lambda some: [docx_bytes(t or "") for t in some], pa.binary())
