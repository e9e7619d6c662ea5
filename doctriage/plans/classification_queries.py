"""Classification end to end, confidence semantics and scorers."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import confidence as C, text as TX
from ..functions.answer_json import extract_answer
from ..operators import extract as X, reports as R
from ..operators.parse import parse_response
from ..operators.score import classify, lexicon_score, recorded_scorer
from ..session import scratch_dir
from ..sources import discover as D
from . import fixtures as fx
from .registry import (EXPECTED, LEVEL_SQL, MODEL_ID, PROMPT_FRAME_SQL, PROMPT_MD5_SQL, PROMPT_TAIL_SQL, REQ, _values,
                       classified, r6, register)
from .stand_ins import rule_scorer


# ===========================================================================
# Classification end to end
# ===========================================================================

@register("classify_batch", f"""
SELECT request_key, document_id, exp_status AS status, exp_stage AS stage, exp_type AS predicted_type,
       exp_score AS primary_score, CAST(0.7 AS DOUBLE) AS threshold, exp_reasoning AS reasoning,
       {PROMPT_MD5_SQL} AS prompt_md5
FROM {EXPECTED}""")
def q_classify_batch(spark, d):
    return classified(spark, d).select("request_key", "document_id", "status", "stage", "predicted_type",
                                       "primary_score", "threshold", "reasoning", "prompt_md5")


@register("type_distribution", f"""
SELECT document_type, n, round(100.0 * n / sum(n) OVER (), 6) AS share_pct FROM (
  SELECT exp_type AS document_type, CAST(count(*) AS BIGINT) AS n FROM {EXPECTED}
  WHERE exp_status = 'success' GROUP BY exp_type)""")
def q_type_distribution(spark, d):
    out = R.type_distribution(classified(spark, d), "status", "predicted_type")
    return out.withColumn("share_pct", F.round("share_pct", 6))


@register("batch_status", f"""
SELECT exp_status AS status, exp_stage AS stage, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT {PROMPT_MD5_SQL}) AS BIGINT) AS prompts
FROM {EXPECTED} GROUP BY 1, 2""")
def q_batch_status(spark, d):
    return classified(spark, d).groupBy("status", "stage").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("prompt_md5").alias("prompts"))


@register("pair_responses", f"""
SELECT request_key, has_answer FROM {EXPECTED}""")
def q_pair_responses(spark, d):
    paired = fx.recorded(spark, d)(fx.requests_fx(spark, d))
    return paired.select("request_key", F.col("response_text").isNotNull().alias("has_answer"))


@register("extract_json", f"""
SELECT request_key,
  CASE shape WHEN 7 THEN 'parse' WHEN 10 THEN 'batch' ELSE 'ok' END AS kind,
  CASE WHEN shape IN (7, 10) THEN NULL WHEN shape = 5 THEN upper(t) WHEN shape = 6 THEN 'spaceship' ELSE t END
    AS raw_type,
  CASE WHEN shape IN (7, 10) THEN NULL WHEN shape = 11 THEN CAST(0.0 AS DOUBLE)
       WHEN shape = 8 THEN CAST(1.5 AS DOUBLE) ELSE s END AS raw_score
FROM {EXPECTED} WHERE has_answer""")
def q_extract_json(spark, d):
    a = fx.answers_fx(spark, d).withColumn("__a", extract_answer(F.col("response_text")))
    return a.select("request_key", F.col("__a.kind").alias("kind"), F.col("__a.predicted_type").alias("raw_type"),
                    F.col("__a.score").alias("raw_score"))


@register("parse_response", f"""
SELECT request_key, exp_type AS predicted_type, exp_score AS primary_score, exp_stage AS stage,
  exp_reasoning AS reasoning,
  CASE WHEN exp_stage <> 'ok' THEN '{{}}'
       WHEN shape = 4 THEN '{{"key_terms": ["' || t || '"], "layout": {{"pages": 1}}}}'
       ELSE '{{"key_terms": ["' || t || '"], "document_structure": "prose"}}' END AS extracted_features
FROM {EXPECTED} WHERE has_answer""")
def q_parse_response(spark, d):
    p = parse_response(fx.answers_fx(spark, d), "response_text")
    return p.select("request_key", "predicted_type", "primary_score", "stage", "reasoning", "extracted_features")


@register("fallback_rows", f"""
SELECT exp_stage AS stage, exp_type AS predicted_type, exp_score AS primary_score,
  CAST(0.7 AS DOUBLE) AS threshold, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT {PROMPT_MD5_SQL}) AS BIGINT) AS prompts
FROM {EXPECTED} WHERE exp_stage <> 'ok' GROUP BY 1, 2, 3, 4""")
def q_fallback_rows(spark, d):
    res = classified(spark, d).where(F.col("stage") != "ok")
    return res.groupBy("stage", "predicted_type", "primary_score", "threshold").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("prompt_md5").alias("prompts"))


# ===========================================================================
# Confidence semantics (D11-D16, D18, D19) over classified results
# ===========================================================================

@register("confidence_level", f"""
SELECT {PROMPT_MD5_SQL} AS prompt_md5, request_key, exp_score AS primary_score, {LEVEL_SQL.format(s='exp_score')} AS confidence_level
FROM {EXPECTED}""")
def q_confidence_level(spark, d):
    return classified(spark, d).select("prompt_md5", "request_key", "primary_score",
                                       C.confidence_level("primary_score").alias("confidence_level"))


@register("is_confident", f"""
SELECT {PROMPT_MD5_SQL} AS prompt_md5, request_key, exp_score >= 0.7 AS is_confident FROM {EXPECTED}""")
def q_is_confident(spark, d):
    return classified(spark, d).select("prompt_md5", "request_key", C.is_confident("primary_score", "threshold")
                                       .alias("is_confident"))


@register("review_flags", f"""
SELECT {PROMPT_MD5_SQL} AS prompt_md5, request_key, exp_score >= 0.8 AS high_confidence, NOT (exp_score >= 0.7) AS needs_review
FROM {EXPECTED}""")
def q_review_flags(spark, d):
    return classified(spark, d).select("prompt_md5", "request_key", C.is_high_confidence("primary_score").alias("high_confidence"),
        C.needs_review("primary_score", "threshold").alias("needs_review"))


@register("review_queue", f"""
SELECT {PROMPT_MD5_SQL} AS prompt_md5, request_key, exp_score AS primary_score FROM {EXPECTED} WHERE exp_score < 0.7""")
def q_review_queue(spark, d):
    return R.review_queue(classified(spark, d)).select("prompt_md5", "request_key", "primary_score")


@register("status_label", f"""
SELECT {PROMPT_MD5_SQL} AS prompt_md5, request_key, CASE WHEN exp_score >= 0.8 THEN 'High confidence result!'
  WHEN exp_score < 0.7 THEN 'Needs human review' ELSE 'Standard confidence result' END AS status_label
FROM {EXPECTED}""")
def q_status_label(spark, d):
    return classified(spark, d).select("prompt_md5", "request_key", C.status_label("primary_score", "threshold")
                                       .alias("status_label"))


@register("accept_code", f"""
SELECT {PROMPT_MD5_SQL} AS prompt_md5, request_key, CASE WHEN exp_status <> 'success' THEN 2 WHEN exp_score >= 0.7 THEN 0 ELSE 1 END AS accept_code
FROM {EXPECTED}""")
def q_accept_code(spark, d):
    res = classified(spark, d)
    return res.select("prompt_md5", "request_key", C.accept_code("primary_score", F.col("status") != "success")
                      .alias("accept_code"))


@register("flat_result", f"""
SELECT {PROMPT_MD5_SQL} AS prompt_md5, document_id, exp_type AS document_type, exp_score AS confidence,
  {LEVEL_SQL.format(s='exp_score')} AS confidence_level, exp_score >= 0.8 AS high_confidence,
  NOT (exp_score >= 0.7) AS needs_review, exp_reasoning AS reasoning,
  (exp_type = 'other' AND exp_reasoning LIKE '%# Limit text length%') AS extraction_failed
FROM {EXPECTED} WHERE exp_status = 'success'""")
def q_flat_result(spark, d):
    res = classified(spark, d).where(F.col("status") == "success")
    return R.flat_results(res, keep=["prompt_md5"])


@register("extraction_failed", f"""
SELECT {PROMPT_MD5_SQL} AS prompt_md5, request_key FROM {EXPECTED} WHERE exp_type = 'other' AND exp_reasoning LIKE '%# Limit text length%'""")
def q_extraction_failed(spark, d):
    res = classified(spark, d)
    return res.where(X.extraction_failed("reasoning", "predicted_type")).select("prompt_md5", "request_key")


VALIDATE_INPUT = [
    [("primary_score", "CAST(event_id % 13 - 1 AS DOUBLE) / 10"),
     ("alt_score", "CAST(event_id % 7 AS DOUBLE) / 5")],
]


@register("validate_scores", f"""
SELECT event_id, CASE WHEN primary_score < 0 OR primary_score > 1 THEN 'Primary score must be between 0.0 and 1.0'
  WHEN alt_score > 1 THEN 'Score for alt must be between 0.0 and 1.0' END AS score_error
FROM ({fx.sql_select('events', VALIDATE_INPUT)})""")
def q_validate_scores(spark, d):
    ev = fx.build(spark, d, "events", VALIDATE_INPUT)
    sec = F.create_map(F.lit("alt"), F.col("alt_score"))
    return ev.select("event_id", C.score_error("primary_score", sec).alias("score_error"))


# ===========================================================================
# Scorers: offline evidence (K3) and a callable run by mapInPandas (K1, K6, K7)
# ===========================================================================

LEXICON = _values(fx.LEXICON_ROWS, ["document_type", "term", "weight"])
LEXICON_SQL = f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM documents),
ev AS (SELECT doc_id, document_type, sum(weight) AS w FROM tok JOIN {LEXICON} l USING (term) GROUP BY 1, 2),
tot AS (SELECT doc_id, sum(w) AS total FROM ev GROUP BY 1),
best AS (SELECT doc_id, document_type, w FROM (SELECT *, row_number() OVER (PARTITION BY doc_id
         ORDER BY w DESC, document_type DESC) AS rn FROM ev) WHERE rn = 1),
kt AS (SELECT doc_id, count(DISTINCT term) AS k FROM tok WHERE term IN (SELECT term FROM {LEXICON}) GROUP BY 1),
scored AS (
  SELECT d.doc_id, d.lang, coalesce(b.document_type, 'unknown') AS predicted_type,
    round(coalesce(b.w / t.total, 0.0), 6) AS primary_score, coalesce(t.total, 0.0) AS evidence,
    CAST(coalesce(kt.k, 0) AS BIGINT) AS n_key_terms
  FROM documents d LEFT JOIN best b USING (doc_id) LEFT JOIN tot t USING (doc_id) LEFT JOIN kt USING (doc_id))
"""


def _lexicon_scored(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang", "text")
    return lexicon_score(docs, fx.LEXICON_ROWS)


@register("lexicon_score", LEXICON_SQL + """
SELECT doc_id, predicted_type, primary_score, evidence, n_key_terms FROM scored""")
def q_lexicon_score(spark, d):
    s = _lexicon_scored(spark, d)
    return s.select("doc_id", "predicted_type", r6("primary_score"), "evidence",
                    F.size("key_terms").cast("bigint").alias("n_key_terms"))


@register("lexicon_accuracy", LEXICON_SQL + """
SELECT CAST(count(*) AS BIGINT) AS documents, CAST(count_if(predicted_type = lang) AS BIGINT) AS correct,
  CAST(count_if(predicted_type = 'unknown') AS BIGINT) AS no_evidence,
  CAST(count_if(predicted_type <> lang AND predicted_type <> 'unknown') AS BIGINT) AS wrong,
  round(count_if(predicted_type = lang) / count(*), 6) AS accuracy FROM scored""")
def q_lexicon_accuracy(spark, d):
    s = _lexicon_scored(spark, d)
    p = F.col("predicted_type")
    return s.agg(F.count(F.lit(1)).alias("documents"), F.count_if(p == F.col("lang")).alias("correct"),
                 F.count_if(p == "unknown").alias("no_evidence"),
                 F.count_if((p != F.col("lang")) & (p != "unknown")).alias("wrong"),
                 F.round(F.count_if(p == F.col("lang")) / F.count(F.lit(1)), 6).alias("accuracy"))



PHRASES = [("en", "of the", 2.0), ("en", "and the", 1.0), ("fr", "é", 1.0), ("fr", "et les", 2.0), ("de", "für", 2.0),
           ("de", "und die", 1.0), ("es", "ciónci", 1.0), ("es", "de los", 2.0)]
# each character that is no letter or digit twice, so that two terms side by side do not share it
_SPACED = r"' ' || regexp_replace(regexp_replace(trim(lower(text)), '\s+', ' ', 'g'), '([^\p{L}\p{N}])', '\1\1', 'g') || ' '"
_FOUND_SQL = ", ".join(
    f"({w!r} * len(regexp_extract_all(s, '[^\\p{{L}}\\p{{N}}]{x.replace(' ', '  ')}[^\\p{{L}}\\p{{N}}]')))::DOUBLE AS e{i}"
    for i, (_, x, w) in enumerate(PHRASES))
_BY_LANG = {t: " + ".join(f"e{i}" for i, x in enumerate(PHRASES) if x[0] == t) for t in ("de", "en", "es", "fr")}


@register("lexicon_phrases", f"""
WITH f AS (SELECT doc_id, {_FOUND_SQL} FROM (SELECT doc_id, {_SPACED} AS s FROM documents)),
v AS (SELECT doc_id, {", ".join(f"{e} AS {t}" for t, e in _BY_LANG.items())} FROM f),
m AS (SELECT *, de + en + es + fr AS evidence, greatest(de, en, es, fr) AS best FROM v)
SELECT doc_id, evidence, CASE WHEN evidence = 0 THEN 'unknown' WHEN fr = best THEN 'fr' WHEN es = best THEN 'es' WHEN en = best THEN 'en'
  ELSE 'de' END AS predicted_type, round(CASE WHEN evidence = 0 THEN 0.0 ELSE best / evidence END, 6) AS primary_score FROM m""")
def q_lexicon_phrases(spark, d):
    """Terms of several words and of letters beyond a-z, found in whole texts by one automaton (K3)."""
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    return lexicon_score(docs, PHRASES).select("doc_id", "evidence", "predicted_type", r6("primary_score"))


PIECE_CHARS = 1000
_PIECE_TYPE = fx._case_list("(doc_id + piece) % 10", S.OFFERED_TYPES)


@register("classify_long", f"""
WITH p AS (
  SELECT request_key, doc_id, piece, substring(document_content, piece * {PIECE_CHARS} + 1, {PIECE_CHARS}) AS content
  FROM (SELECT *, unnest(range(greatest(1, CAST(ceil(length(document_content) / {PIECE_CHARS}.0) AS BIGINT)))) AS piece FROM {REQ})),
a AS (
  SELECT *, (doc_id + piece) % 13 <> 0 AS ok, {_PIECE_TYPE} AS t, greatest(1, length(content))::DOUBLE AS chars,
         (length(content) % 101) / 100.0::DOUBLE AS s, md5('{PROMPT_FRAME_SQL}' || content || '{PROMPT_TAIL_SQL}') AS h FROM p),
d AS (SELECT request_key, count(*) AS pieces, count_if(NOT ok) AS failed_pieces, sum(chars) FILTER (WHERE ok) AS chars,
             md5(string_agg(h, ',' ORDER BY piece)) AS prompts_md5 FROM a GROUP BY request_key),
v AS (SELECT request_key, t, sum(chars * s) AS votes FROM a WHERE ok GROUP BY request_key, t),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY request_key ORDER BY round(votes, 4) DESC, t) = 1)
SELECT d.request_key, CASE WHEN t IS NULL THEN 'error' ELSE 'success' END AS status, coalesce(t, 'unknown') AS predicted_type,
  round(coalesce(votes / chars, 0.0), 6) AS primary_score, pieces::BIGINT AS pieces, failed_pieces::BIGINT AS failed_pieces, prompts_md5
FROM d LEFT JOIN b ON b.request_key = d.request_key""")
def q_classify_long(spark, d):
    """Whole texts in pieces of 1000 characters, each scored, merged by a weighted vote (K4, K5)."""
    from ..operators.long_texts import classify_long, cut_pieces
    req = fx.requests_fx(spark, d)
    score = F.format_string("%.2f", F.length("document_content") % 101 / F.lit(100.0))
    answers = cut_pieces(req, PIECE_CHARS).where("(doc_id + piece) % 13 <> 0").select("request_key", F.format_string(
        '{"predicted_type": "%s", "confidence_score": %s}', F.expr(_PIECE_TYPE), score).alias("response_text"))
    out = classify_long(req, recorded_scorer(answers), PIECE_CHARS, model=MODEL_ID)
    return out.select("request_key", "status", "predicted_type", r6("primary_score"), "pieces", "failed_pieces", "prompts_md5")


PROMPT_FIXED_CHARS = len(S.PROMPT_HEAD + ", ".join(S.OFFERED_TYPES) + S.PROMPT_MIDDLE + S.PROMPT_TAIL)
TYPE_BY_N = fx._case_list("n % 10", S.OFFERED_TYPES)


@register("classify_callable", f"""
SELECT request_key,
  CASE WHEN n % 23 = 0 THEN 'api' WHEN n % 29 = 0 THEN 'batch' ELSE 'ok' END AS stage,
  CASE WHEN n % 23 <> 0 AND n % 29 = 0 THEN 'error' ELSE 'success' END AS status,
  CASE WHEN n % 23 = 0 OR n % 29 = 0 THEN 'unknown' ELSE {TYPE_BY_N} END AS predicted_type,
  CASE WHEN n % 23 = 0 OR n % 29 = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(n % 101 AS DOUBLE) / 100 END
    AS primary_score,
  CASE WHEN n % 23 = 0 THEN 'Classification failed due to API error: ThrottlingException: rate exceeded'
       WHEN n % 29 = 0 THEN 'Batch processing failed: connection reset'
       ELSE 'length ' || CAST(n AS VARCHAR) END AS reasoning
FROM (SELECT request_key, {PROMPT_FIXED_CHARS} + length(document_content) AS n FROM {REQ})""")
def q_classify_callable(spark, d):
    from ..operators.score import function_scorer
    res = classify(fx.requests_fx(spark, d), function_scorer(rule_scorer, partitions=8), model=MODEL_ID)
    return res.select("request_key", "stage", "status", "predicted_type", "primary_score", "reasoning")


@register("classify_incremental", f"""
SELECT request_key, document_id, exp_status AS status, exp_stage AS stage, exp_type AS predicted_type,
       exp_score AS primary_score, {PROMPT_MD5_SQL} AS prompt_md5 FROM {EXPECTED}""")
def q_classify_incremental(spark, d):
    """Two runs into one table: the second scores only what the first did not (K5 re-run safety)."""
    from ..operators.score import classify_to_table
    table = scratch_dir(spark, "scored-table")
    req = fx.requests_fx(spark, d)
    scorer = fx.recorded(spark, d)
    classify_to_table(req.where(F.col("doc_id") % 3 == 0), scorer, table, model=MODEL_ID)
    out = classify_to_table(req, scorer, table, model=MODEL_ID, chunks=2)
    return out.select("request_key", "document_id", "status", "stage", "predicted_type", "primary_score", "prompt_md5")


@register("run_batch", f"""
SELECT document_id, source, exp_status AS status,
  CASE WHEN exp_status = 'success' THEN exp_type END AS document_type,
  CASE WHEN exp_status = 'success' THEN exp_score END AS confidence,
  CAST(CASE WHEN exp_status = 'success' AND exp_score >= 0.7 THEN 0 WHEN exp_status = 'success' THEN 1 ELSE 2 END
    AS BIGINT) AS cli_exit_code
FROM ({fx.sql_select('documents', fx.EXPECTED_LAYERS, ['document_id', 'uri AS source', 'exp_status', 'exp_type',
                                                        'exp_score'])})""")
def q_run_batch(spark, d):
    """The batch entry end to end over discovered documents (3.3)."""
    from .batch import run_batch
    req = fx.requests_fx(spark, d)
    docs = D.conform(req.select(
        "document_id", "source", "source_type",
        F.when(F.col("source_type") == "text", F.col("document_content")).alias("text"),
        F.col("document_content").alias("extracted")))
    records, _, _ = run_batch(docs, fx.recorded(spark, d), MODEL_ID, extracted_col="extracted",
                              options={"model": "nova-lite"})
    return records.select("document_id", "source", "status", F.col("classification.document_type").alias(
        "document_type"), F.col("classification.confidence").alias("confidence"), "cli_exit_code")


@register("scorer_requests", f"""
SELECT request_key, '{MODEL_ID}' AS model_id, 2048 AS max_tokens, CAST(0.1 AS DOUBLE) AS temperature,
  CAST(0.9 AS DOUBLE) AS top_p, 'user' AS role,
  md5('{PROMPT_FRAME_SQL}' || document_content || '{PROMPT_TAIL_SQL}') AS prompt_md5
FROM {REQ}""")
def q_scorer_requests(spark, d):
    """The model-call payload for every request (K1 parameters)."""
    from ..operators.score import scorer_request
    p = scorer_request(TX.build_prompt(X.resolve_text("document_content")), MODEL_ID)
    return fx.requests_fx(spark, d).select(
        "request_key", p.modelId.alias("model_id"), p.inferenceConfig.maxTokens.alias("max_tokens"),
        p.inferenceConfig.temperature.alias("temperature"), p.inferenceConfig.topP.alias("top_p"),
        p.messages[0].role.alias("role"), F.md5(p.messages[0].content[0].text).alias("prompt_md5"))


@register("batch_local_errors", f"""
SELECT document_id, source,
  CASE WHEN source_type = 'local' AND doc_id % 19 = 0 THEN 'error' ELSE exp_status END AS status,
  CASE WHEN source_type = 'local' AND doc_id % 19 = 0 THEN 'File not found: ' || uri
       WHEN exp_stage = 'batch' THEN '''list'' object has no attribute ''get'''
       WHEN exp_stage = 'missing' THEN 'no recorded answer for request ' || request_key END AS error,
  CAST(CASE WHEN source_type = 'local' AND doc_id % 19 = 0 THEN 2 WHEN exp_status <> 'success' THEN 2
       WHEN exp_score >= 0.7 THEN 0 ELSE 1 END AS BIGINT) AS cli_exit_code
FROM ({fx.sql_select('documents', fx.EXPECTED_LAYERS, ['doc_id', 'source_type', 'uri', 'document_id',
                                                        'uri AS source', 'request_key', 'exp_stage', 'exp_status',
                                                        'exp_score'])})""")
def q_batch_local_errors(spark, d):
    """A local file that cannot be read is an error row and is never scored (Q21)."""
    from .batch import run_batch
    req = fx.requests_fx(spark, d)
    unreadable = (F.col("source_type") == "local") & (F.col("doc_id") % 19 == 0)
    docs = D.conform(req.select(
        "document_id", "source", "source_type",
        F.when(F.col("source_type") == "text", F.col("document_content")).alias("text"),
        F.when(~unreadable, F.col("document_content")).alias("extracted"),
        F.when(unreadable, F.concat(F.lit("File not found: "), F.col("source"))).alias("extract_error")))
    records, _, _ = run_batch(docs, fx.recorded(spark, d), MODEL_ID, extracted_col="extracted",
                              extraction_error_col="extract_error")
    return records.select("document_id", "source", "status", "error", "cli_exit_code")
