"""Requests, prompt and text; paths and extraction routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import paths as P, text as TX
from ..operators import extract as X, requests as RQ
from ..schemas import PROMPT_TEXT_LIMIT
from . import fixtures as fx
from .registry import PROMPT_FRAME_SQL, PROMPT_TAIL_SQL, REQ, register
from .stand_ins import flaky_service, local_decoder


# ===========================================================================
# Requests, prompt, text
# ===========================================================================

@register("truncate_text", """
SELECT doc_id, md5(substring(text, 1, 3000)) AS head_md5, CAST(length(substring(text, 1, 3000)) AS INTEGER) AS head_chars
FROM documents""")
def q_truncate_text(spark, d):
    t = TX.truncate_text("text", PROMPT_TEXT_LIMIT)
    return spark.read.parquet(f"{d}/documents.parquet").select(
        "doc_id", F.md5(t).alias("head_md5"), F.length(t).alias("head_chars"))




@register("build_prompt", f"""
SELECT request_key, md5(p) AS prompt_md5, CAST(length(p) AS INTEGER) AS prompt_chars FROM (
  SELECT request_key, '{PROMPT_FRAME_SQL}' || document_content || '{PROMPT_TAIL_SQL}' AS p
  FROM {REQ})""")
def q_build_prompt(spark, d):
    p = TX.build_prompt(X.resolve_text("document_content"))
    return fx.requests_fx(spark, d).select("request_key", F.md5(p).alias("prompt_md5"),
                                           F.length(p).alias("prompt_chars"))


@register("previews", """
SELECT doc_id, substring(text, 1, 50) AS text_preview, substring(text, 1, 100) AS reasoning_preview,
  substring(text, 1, 200) AS output_preview FROM documents""")
def q_previews(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select(
        "doc_id", TX.preview("text", 50).alias("text_preview"), TX.preview("text", 100).alias("reasoning_preview"),
        TX.preview("text", 200).alias("output_preview"))


@register("requests_from_text", """
SELECT CASE WHEN doc_id % 2 = 0 THEN 'doc_' || CAST(doc_id AS VARCHAR) ELSE 'text-input' END AS document_id,
  'direct://text-input' AS document_uri, md5(text) AS content_md5, lang FROM documents""")
def q_requests_from_text(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select(
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))).alias("id"),
        "text", "lang")
    r = RQ.requests_from_text(docs, "text", "id")
    return r.select("document_id", "document_uri", F.md5("document_content").alias("content_md5"), "lang")


@register("source_dispatch", f"""
SELECT request_key, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE source_type END AS route,
  CASE WHEN doc_id % 13 = 0 THEN 'Unsupported source type: ftp' END AS dispatch_error FROM {REQ}""")
def q_source_dispatch(spark, d):
    r = fx.requests_fx(spark, d).withColumn(
        "source_type", F.when(F.col("doc_id") % 13 == 0, F.lit("ftp")).otherwise(F.col("source_type")))
    return RQ.dispatch_sources(r).select("request_key", "route", "dispatch_error")


@register("validate_requests", f"""
SELECT request_key, CASE WHEN doc_id % 29 = 0 THEN 'Document ID is required'
  WHEN doc_id % 31 = 0 THEN 'Document URI is required' END AS request_error FROM {REQ}""")
def q_validate_requests(spark, d):
    r = fx.requests_fx(spark, d).select(
        "request_key",
        F.when(F.col("doc_id") % 29 == 0, F.lit("")).otherwise(F.col("document_id")).alias("document_id"),
        F.when(F.col("doc_id") % 31 == 0, F.lit("")).otherwise(F.col("source")).alias("document_uri"))
    return RQ.validate_requests(r).select("request_key", "request_error")


@register("request_from_json", f"""
SELECT CASE WHEN doc_id % 5 = 0 THEN '' ELSE document_id END AS document_id, source AS document_uri,
  '{{}}' AS document_metadata, '{{}}' AS classification_config,
  CASE WHEN doc_id % 3 = 0 THEN 'user' || CAST(doc_id % 7 AS VARCHAR) END AS requester_id FROM {REQ}""")
def q_request_from_json(spark, d):
    r = fx.requests_fx(spark, d)
    rec = F.struct(
        F.when(F.col("doc_id") % 5 != 0, F.col("document_id")).alias("document_id"),
        F.col("source").alias("document_uri"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("user"), (F.col("doc_id") % 7).cast("string")))
         .alias("requester_id"))
    j = r.select(F.to_json(rec).alias("value"))
    return RQ.request_from_json(j).select("document_id", "document_uri", "document_metadata",
                                          "classification_config", "requester_id")


@register("request_to_json", f"""
SELECT '{{"document_id":"' || document_id || '","document_uri":"' || source || '","document_content":"' || lang
  || '","document_metadata":{{"size":' || CAST(n_chars AS VARCHAR) || '}},"classification_config":{{}},'
  || '"requester_id":null}}' AS request_json FROM {REQ}""")
def q_request_to_json(spark, d):
    r = fx.requests_fx(spark, d).select(
        "document_id", F.col("source").alias("document_uri"), F.col("lang").alias("document_content"),
        F.concat(F.lit('{"size":'), F.col("n_chars").cast("string"), F.lit("}")).alias("document_metadata"),
        F.lit(None).cast("string").alias("classification_config"),
        F.lit(None).cast("string").alias("requester_id"))
    return RQ.request_to_json(r).select("request_json")


@register("run_options", f"""
SELECT request_key, 'claude-3-haiku' AS model, 'us-west-2' AS region, 120 AS timeout FROM {REQ}""")
def q_run_options(spark, d):
    r = fx.requests_fx(spark, d).withColumn("model", F.lit("row-model"))
    return RQ.with_run_options(r, model="claude-3-haiku", region="us-west-2", timeout=120).select(
        "request_key", "model", "region", "timeout")


# ===========================================================================
# Paths and routing
# ===========================================================================

@register("parse_uri", f"""
SELECT request_key,
  CASE WHEN source_type = 's3' THEN split_part(substring(source, 6), '/', 1) END AS bucket,
  CASE WHEN source_type = 's3' THEN lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.' || ext END AS key,
  CASE WHEN source_type = 's3' THEN NULL ELSE 'Invalid S3 URI: ' || source END AS uri_error FROM {REQ}""")
def q_parse_uri(spark, d):
    u = P.parse_s3_uri("source")
    return fx.requests_fx(spark, d).select("request_key", u.bucket.alias("bucket"), u.key.alias("key"),
                                           u.error.alias("uri_error"))


@register("document_stem", f"""
SELECT request_key, CASE WHEN source_type = 'text' THEN 'text-input' ELSE document_id END AS stem,
  CASE WHEN source_type = 'text' THEN '' ELSE '.' || ext END AS suffix FROM {REQ}""")
def q_document_stem(spark, d):
    return fx.requests_fx(spark, d).select("request_key", P.path_stem("source").alias("stem"),
                                           P.path_suffix("source").alias("suffix"))


@register("pattern_filter", f"""
SELECT request_key FROM {REQ}
WHERE (source_type = 's3' AND source LIKE 's3://src1%' AND ext = 'pdf')
   OR (source_type = 'local' AND ext = 'md' AND CAST(doc_id AS VARCHAR) LIKE '1%')""")
def q_pattern_filter(spark, d):
    r = fx.requests_fx(spark, d)
    key = F.regexp_replace("source", "^s3://", "")
    s3 = (F.col("source_type") == "s3") & P.prefix_match("source", "s3://src1") & P.key_pattern_match(key, "*.pdf")
    local = (F.col("source_type") == "local") & P.name_glob_match("source", "doc_1*.md")
    return r.where(s3 | local).select("request_key")


@register("route_by_suffix", f"""
SELECT request_key, CASE WHEN source_type = 'text' THEN 'other' WHEN ext = 'pdf' THEN 'pdf'
  WHEN ext IN ('txt', 'md') THEN 'text' WHEN ext = 'docx' THEN 'docx' WHEN ext IN ('jpg', 'TIFF') THEN 'image'
  ELSE 'other' END AS extractor FROM {REQ}""")
def q_route_by_suffix(spark, d):
    return fx.requests_fx(spark, d).select("request_key", X.route_by_suffix("source").alias("extractor"))


@register("resolve_text", f"""
SELECT request_key, md5(document_content) AS text_md5, CAST(length(document_content) AS INTEGER) AS text_chars,
  doc_id % 11 = 0 AS was_empty FROM {REQ}""")
def q_resolve_text(spark, d):
    r = fx.requests_fx(spark, d)
    t = X.resolve_text("document_content", F.lit(None).cast("string"))
    return r.select("request_key", F.md5(t).alias("text_md5"), F.length(t).alias("text_chars"),
                    (F.col("document_content") == "").alias("was_empty"))


@register("ocr_lines", """
SELECT doc_id, md5(text) AS text_md5 FROM documents""")
def q_ocr_lines(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    lines = F.transform(F.split(F.col("text"), "\n", -1),
                        lambda x: F.struct(F.lit("LINE").alias("BlockType"), x.alias("Text")))
    page = F.array(F.struct(F.lit("PAGE").alias("BlockType"), F.lit(None).cast("string").alias("Text")))
    word = F.array(F.struct(F.lit("WORD").alias("BlockType"),
                            F.regexp_extract("text", r"^(\S*)", 1).alias("Text")))
    resp = docs.select("doc_id", F.to_json(F.struct(F.concat(page, lines, word).alias("Blocks"))).alias("resp"))
    blocks = F.from_json("resp", f"struct<Blocks:{S.OCR_BLOCKS_TYPE.simpleString()}>").Blocks
    return resp.select("doc_id", F.md5(X.ocr_lines(blocks)).alias("text_md5"))




@register("extractor_fallback", """
SELECT doc_id, CASE WHEN octet_length(encode(text)) % 5 = 0 THEN 'local' ELSE 'service' END AS extractor,
  md5(text) AS text_md5, CASE WHEN octet_length(encode(text)) % 5 = 0 THEN 1 ELSE 0 END AS failures
FROM documents""")
def q_extractor_fallback(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    out = X.extract_with_fallback(docs, [flaky_service, local_decoder], names=["service", "local"])
    return out.select("doc_id", "extractor", F.md5("text").alias("text_md5"),
                      F.size("extraction_errors").alias("failures"))
