"""Result records: locations, JSON round trips, validation, CSV and metadata sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extract as X, reports as R
from ..session import scratch_dir
from ..sinks import writers as W
from . import fixtures as fx
from .registry import LEVEL_SQL, MODEL_ID, RES, register


# ===========================================================================
# Result records
# ===========================================================================

ISO_SQL = ("CASE WHEN epoch_us({t}) % 1000000 <> 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' "
           "ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S') || '+00:00' END")


@register("result_uri", f"""
SELECT document_id,
  's3://out-bucket/classification-results/classified/' || strftime(timestamp, '%Y/%m/%d/%H') || '/' || document_id
    || '/result.json' AS result_uri,
  's3://out-bucket/classification-results/metadata/' || strftime(timestamp, '%Y/%m/%d') || '/' || document_id
    || '/processing.json' AS metadata_uri,
  strftime(timestamp, '%Y') AS year, strftime(timestamp, '%m') AS month, strftime(timestamp, '%d') AS day,
  strftime(timestamp, '%H') AS hour FROM {RES}""")
def q_result_uri(spark, d):
    r = W.with_result_location(fx.results_fx(spark, d), "classification-results/", "out-bucket")
    return r.select("document_id", "result_uri", "metadata_uri", "year", "month", "day", "hour")


@register("result_to_json", f"""
SELECT event_id, '{{"document_id":"' || document_id || '","predicted_type":"' || document_type
  || '","confidence":{{"primary_score":' || CAST(confidence AS VARCHAR) || ',"secondary_scores":{{}},'
  || '"threshold":0.7,"is_confident":' || CASE WHEN confidence >= 0.7 THEN 'true' ELSE 'false' END
  || ',"confidence_level":"' || {LEVEL_SQL.format(s='confidence')} || '"}},"reasoning":null,'
  || '"extracted_features":{{}},"processing_time_ms":'
  || coalesce(CAST(CAST(floor(processing_time_ms) AS BIGINT) AS VARCHAR), 'null')
  || ',"model_used":"' || model || '","timestamp":"' || {ISO_SQL.format(t='timestamp')} || '"}}' AS result_json
FROM {RES} WHERE status = 'success'""")
def q_result_to_json(spark, d):
    from ..functions.results import result_to_json
    r = fx.results_fx(spark, d).where(F.col("status") == "success").select(
        "event_id", "document_id", F.col("document_type").alias("predicted_type"),
        F.col("confidence").alias("primary_score"), F.create_map().cast("map<string,double>").alias("secondary_scores"),
        F.lit(0.7).alias("threshold"), F.lit(None).cast("string").alias("reasoning"),
        F.lit("{}").alias("extracted_features"),
        F.floor("processing_time_ms").cast("bigint").alias("processing_time_ms"),
        F.col("model").alias("model_used"), "timestamp")
    return r.select("event_id", result_to_json().alias("result_json"))


RECORD_INPUT = [
    [("rec", "'{\"document_id\": \"' || CASE WHEN event_id % 50 = 0 THEN '' ELSE 'doc_' || CAST(event_id AS STRING) END"
             " || '\", \"predicted_type\": \"' || CASE WHEN event_id % 9 = 0 THEN 'INVOICE' WHEN event_id % 9 = 1"
             " THEN 'memo' ELSE 'report' END || '\", \"confidence\": {\"primary_score\": 0.' ||"
             " lpad(CAST(event_id % 100 AS STRING), 2, '0') || '}, \"timestamp\": \"2024-01-0' ||"
             " CAST(event_id % 9 + 1 AS STRING) || 'T10:00:00' || CASE WHEN event_id % 2 = 0 THEN 'Z' ELSE"
             " '+00:00' END || '\"}'")],
]


@register("result_from_json", f"""
SELECT event_id, CASE WHEN event_id % 50 = 0 THEN '' ELSE 'doc_' || CAST(event_id AS VARCHAR) END AS document_id,
  CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN 'memo' ELSE 'report' END AS predicted_type,
  CAST(event_id % 100 AS DOUBLE) / 100 AS primary_score, CAST(0.7 AS DOUBLE) AS threshold,
  '2024-01-0' || CAST(event_id % 9 + 1 AS VARCHAR) || ' 10:00:00' AS ts_text,
  CASE WHEN event_id % 9 = 0 THEN '''INVOICE'' is not a valid DocumentType'
       WHEN event_id % 50 = 0 THEN 'Document ID is required' END AS record_error
FROM events""")
def q_result_from_json(spark, d):
    from ..functions.results import result_from_json, utc_wall
    ev = fx.build(spark, d, "events", RECORD_INPUT)
    r = result_from_json(ev, "rec")
    return r.select("event_id", "document_id", "predicted_type", F.col("confidence.primary_score").alias("primary_score"),
                    F.col("confidence.threshold").alias("threshold"),
                    F.date_format(utc_wall("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("ts_text"), "record_error")


@register("validate_results", """
SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'Document ID is required' END AS result_error FROM events""")
def q_validate_results(spark, d):
    from ..functions.results import result_error
    ev = spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", F.when(F.col("event_id") % 50 == 0, F.lit("")).otherwise(
            F.concat(F.lit("doc_"), F.col("event_id").cast("string"))).alias("document_id"))
    return ev.select("event_id", result_error("document_id").alias("result_error"))


@register("summary_projection", f"""
SELECT document_id, source, status, CASE WHEN status = 'success' THEN document_type END AS document_type,
  CASE WHEN status = 'success' THEN CAST(confidence AS VARCHAR) END AS confidence,
  CASE WHEN status = 'success' THEN {LEVEL_SQL.format(s='confidence')} END AS confidence_level,
  CAST(processing_time_ms AS VARCHAR) AS processing_time_ms, {ISO_SQL.format(t='timestamp')} AS timestamp
FROM {RES}""")
def q_summary_projection(spark, d):
    path = scratch_dir(spark, "summary-csv")
    W.write_summary_csv(fx.results_fx(spark, d), path)
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path)


@register("metadata_rows", f"""
SELECT document_id, source AS source_uri, {ISO_SQL.format(t='timestamp')} AS processing_start,
  processing_time_ms AS processing_duration_ms, '{MODEL_ID}' AS bedrock_model,
  CAST(0.7 AS DOUBLE) AS confidence_threshold,
  CASE WHEN status = 'success' THEN 'completed' ELSE status END AS status, strftime(timestamp, '%d') AS day,
  CASE WHEN status = 'success' THEN CAST(event_id % 4 AS INTEGER) END AS textract_pages
FROM {RES}""")
def q_metadata_rows(spark, d):
    path = scratch_dir(spark, "metadata-by-day")
    res = fx.results_fx(spark, d)
    # an OCR response with as many pages as event_id % 4, each with a line
    page = lambda kind: F.struct(F.lit(kind).alias("BlockType"), F.lit("x").alias("Text"))
    blocks = F.flatten(F.array_repeat(F.array(page("PAGE"), page("LINE")), (F.col("event_id") % 4).cast("int")))
    res = res.withColumn("pages", F.when(F.col("status") == "success", X.ocr_pages(blocks)))
    W.write_by_day(W.metadata_rows(res, MODEL_ID, keep=["timestamp"], pages="pages"), path)
    back = spark.read.schema(
        "document_id string, source_uri string, processing_start string, processing_duration_ms double, "
        "bedrock_model string, confidence_threshold double, status string, timestamp timestamp, textract_pages int, "
        "year string, month string, day string").json(path)
    return back.select("document_id", "source_uri", "processing_start", "processing_duration_ms", "bedrock_model",
                       "confidence_threshold", "status", "day", "textract_pages")


@register("write_results_both", f"""
SELECT r.document_id, r.status, CASE WHEN r.status = 'success' THEN r.document_type END AS document_type,
  CASE WHEN r.status = 'success' THEN CAST(r.confidence AS VARCHAR) END AS confidence_text, r.confidence
FROM {RES} r""")
def q_write_results_both(spark, d):
    """Both formats of one batch, the CSV made from the JSON, read back side by side."""
    path = scratch_dir(spark, "results-both")
    res = fx.results_fx(spark, d)
    W.write_results(res, path, format="both")
    csv = (spark.read.option("header", "true").option("inferSchema", "false").csv(f"{path}/summary")
           .select("document_id", "status", "document_type", F.col("confidence").alias("confidence_text")))
    detailed = spark.read.schema("document_id string, confidence double").json(f"{path}/detailed")
    return csv.join(detailed, "document_id")


@register("report_file", f"""
SELECT document_type, n, processed_count, success_count, high_confidence, rows_written
FROM (SELECT document_type, CAST(count(*) AS BIGINT) AS n FROM {RES} WHERE status = 'success' AND document_type IS NOT NULL GROUP BY 1),
     (SELECT CAST(count(*) AS BIGINT) AS processed_count, CAST(count_if(status = 'success') AS BIGINT) AS success_count,
             CAST(count_if(status = 'success' AND confidence > 0.8) AS BIGINT) AS high_confidence,
             CAST(count(*) AS BIGINT) AS rows_written FROM {RES})""")
def q_report_file(spark, d):
    """The batch report written with its rows, and read back type by type."""
    path = scratch_dir(spark, "report")
    res = fx.results_fx(spark, d)
    W.write_report(R.batch_report(res), W.batch_records(res), path)
    back = spark.read.schema("batch_summary struct<processed_count bigint, success_count bigint>, document_types map<string, bigint>, "
                             "confidence_stats struct<high_confidence bigint>").json(f"{path}/summary")
    rows = spark.read.schema("document_id string").json(f"{path}/results").agg(F.count("*").alias("rows_written"))
    types = back.select(F.explode("document_types").alias("document_type", "n"), F.col("batch_summary.processed_count").alias("processed_count"),
                        F.col("batch_summary.success_count").alias("success_count"), F.col("confidence_stats.high_confidence").alias("high_confidence"))
    return types.join(rows.withColumn("one", F.lit(1)), F.col("one") == 1).drop("one")
