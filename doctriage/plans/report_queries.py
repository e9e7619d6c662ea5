"""Catalogue look-ups and batch reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import catalog as CAT, ranking as K, reports as R
from ..operators.score import classify
from ..sources import discover as D
from . import fixtures as fx
from .registry import ALIASES, CATALOG, EXPECTED, MODEL_ID, PRICES, REQ, RES, TYPES, classified, r6, register


# ===========================================================================
# Look-ups and dimensions
# ===========================================================================

@register("model_alias", f"""
SELECT r.event_id, r.model, coalesce(a.alias, r.model) AS model_alias
FROM {RES} r LEFT JOIN {ALIASES} a ON r.model = a.model""")
def q_model_alias(spark, d):
    return CAT.with_model_alias(fx.results_fx(spark, d)).select("event_id", "model", "model_alias")


@register("model_id", f"""
SELECT r.event_id, coalesce(c.model_id, coalesce(a.alias, r.model)) AS model_id
FROM {RES} r LEFT JOIN {ALIASES} a ON r.model = a.model LEFT JOIN {CATALOG} c ON coalesce(a.alias, r.model) = c.alias""")
def q_model_id(spark, d):
    return CAT.with_model_id(CAT.with_model_alias(fx.results_fx(spark, d))).select("event_id", "model_id")


@register("model_catalog", f"""
SELECT coalesce(a.alias, r.model) AS model_alias, c.name AS model_name, c.cost AS model_cost,
  c.speed AS model_speed, CAST(count(*) AS BIGINT) AS runs
FROM {RES} r LEFT JOIN {ALIASES} a ON r.model = a.model LEFT JOIN {CATALOG} c ON coalesce(a.alias, r.model) = c.alias
GROUP BY 1, 2, 3, 4""")
def q_model_catalog(spark, d):
    per = CAT.with_model_alias(fx.results_fx(spark, d)).groupBy("model_alias").agg(F.count(F.lit(1)).alias("runs"))
    return CAT.with_model_attributes(per).select("model_alias", "model_name", "model_cost", "model_speed", "runs")


@register("type_families", f"""
SELECT t.family, CAST(count(*) AS BIGINT) AS n FROM {RES} r JOIN {TYPES} t ON r.document_type = t.document_type
WHERE r.status = 'success' GROUP BY 1""")
def q_type_families(spark, d):
    ok = fx.results_fx(spark, d).where(F.col("status") == "success")
    # broadcast look-up first (narrow), then one aggregation: a single shuffle
    return CAT.with_type_family(ok).groupBy("family").agg(F.count(F.lit(1)).alias("n"))


@register("document_types", f"""
SELECT exp_type AS document_type, CAST(count(*) AS BIGINT) AS n FROM {EXPECTED}
WHERE exp_status = 'success' AND exp_type IN (SELECT document_type FROM {TYPES}) GROUP BY 1""")
def q_document_types(spark, d):
    res = classified(spark, d).where(F.col("status") == "success")
    per = res.groupBy(F.col("predicted_type").alias("document_type")).agg(F.count(F.lit(1)).alias("n"))
    return CAT.with_type_family(per).where(F.col("family").isNotNull()).select("document_type", "n")


MATRIX_MODELS = ["nova-lite", "claude-haiku", "claude-sonnet"]


@register("case_model_matrix", f"""
SELECT item_id, m.model FROM benchmark, (VALUES ('nova-lite'), ('claude-haiku'), ('claude-sonnet')) AS m(model)""")
def q_case_model_matrix(spark, d):
    cases = spark.read.parquet(f"{d}/benchmark.parquet").select("item_id")
    return R.case_model_matrix(cases, MATRIX_MODELS)


@register("expectation_check", f"""
SELECT request_key, exp_type = t AS type_matches, exp_score < 0.8 AS under_ceiling FROM {EXPECTED}""")
def q_expectation_check(spark, d):
    # answers and expectations are one stored table by key: one join serves both
    res = classify(fx.requests_fx(spark, d), fx.recorded_with_expectations(spark, d), model=MODEL_ID)
    out = R.expectation_check(res, None, "request_key")
    return out.select("request_key", "type_matches", "under_ceiling")


# ===========================================================================
# Reports over batch results
# ===========================================================================

@register("batch_totals", f"""
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count_if(status = 'success') AS BIGINT) AS successful,
  CAST(count_if(status = 'error') AS BIGINT) AS errors, CAST(count_if(status = 'timeout') AS BIGINT) AS timeouts,
  round(100.0 * count_if(status = 'success') / count(*), 6) AS success_pct,
  round(100.0 * count_if(status = 'error') / count(*), 6) AS error_pct,
  round(100.0 * count_if(status = 'timeout') / count(*), 6) AS timeout_pct FROM {RES}""")
def q_batch_totals(spark, d):
    t = R.batch_totals(fx.results_fx(spark, d))
    return t.select("total", "successful", "errors", "timeouts", r6("success_pct"), r6("error_pct"),
                    r6("timeout_pct"))


@register("avg_time", f"""
SELECT round(coalesce(avg(processing_time_ms), 0), 6) AS avg_time_ms FROM {RES}""")
def q_avg_time(spark, d):
    return R.avg_time(fx.results_fx(spark, d)).select(r6("avg_time_ms"))


@register("result_type_distribution", f"""
SELECT document_type, n, round(100.0 * n / sum(n) OVER (), 6) AS share_pct FROM (
  SELECT coalesce(document_type, 'unknown') AS document_type, CAST(count(*) AS BIGINT) AS n FROM {RES}
  WHERE status = 'success' GROUP BY 1)""")
def q_result_type_distribution(spark, d):
    return R.type_distribution(fx.results_fx(spark, d)).withColumn("share_pct", F.round("share_pct", 6))


@register("confidence_bands", f"""
SELECT CAST(count_if(status = 'success' AND coalesce(confidence, 0) >= 0.8) AS BIGINT) AS high,
  CAST(count_if(status = 'success' AND coalesce(confidence, 0) >= 0.5 AND coalesce(confidence, 0) < 0.8) AS BIGINT)
    AS medium,
  CAST(count_if(status = 'success' AND coalesce(confidence, 0) < 0.5) AS BIGINT) AS low FROM {RES}""")
def q_confidence_bands(spark, d):
    return R.confidence_bands(fx.results_fx(spark, d))


@register("report_bands", f"""
SELECT CAST(count_if(ok AND c > 0.8) AS BIGINT) AS high_confidence,
  CAST(count_if(ok AND c > 0.5 AND c <= 0.8) AS BIGINT) AS medium_confidence,
  CAST(count_if(ok AND c <= 0.5) AS BIGINT) AS low_confidence
FROM (SELECT status = 'success' AND document_type IS NOT NULL AS ok, coalesce(confidence, 0) AS c FROM {RES})""")
def q_report_bands(spark, d):
    return R.report_bands(fx.results_fx(spark, d))


@register("report_totals", f"""
SELECT CAST(count(*) AS BIGINT) AS processed_count, CAST(count_if(status = 'success') AS BIGINT) AS success_count,
  CAST(count_if(status <> 'success') AS BIGINT) AS error_count FROM {RES}""")
def q_report_totals(spark, d):
    return R.report_totals(fx.results_fx(spark, d))


@register("report_types", f"""
SELECT document_type, CAST(count(*) AS BIGINT) AS n FROM {RES}
WHERE status = 'success' AND document_type IS NOT NULL GROUP BY 1""")
def q_report_types(spark, d):
    m = R.report_types(fx.results_fx(spark, d))
    return m.select(F.explode("document_types").alias("document_type", "n"))


@register("batch_report", f"""
SELECT CAST(count(*) AS BIGINT) AS processed_count, CAST(count_if(status = 'success') AS BIGINT) AS success_count,
  CAST(count_if(status <> 'success') AS BIGINT) AS error_count,
  CAST(count(DISTINCT CASE WHEN status = 'success' THEN document_type END) AS BIGINT) AS types,
  CAST(count_if(status = 'success' AND confidence > 0.8) AS BIGINT) AS high_confidence FROM {RES}""")
def q_batch_report(spark, d):
    r = R.batch_report(fx.results_fx(spark, d))
    return r.select(F.col("batch_summary.processed_count").alias("processed_count"),
                    F.col("batch_summary.success_count").alias("success_count"),
                    F.col("batch_summary.error_count").alias("error_count"),
                    F.size("document_types").cast("bigint").alias("types"),
                    F.col("confidence_stats.high_confidence").alias("high_confidence"))


@register("dashboard", f"""
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count_if(status = 'success') AS BIGINT) AS success,
  CAST(count(*) - count_if(status = 'success') AS BIGINT) AS errors,
  round(avg(coalesce(processing_time_ms, 0)), 6) AS avg_time_ms,
  round(100.0 * count_if(status = 'success') / count(*), 6) AS success_pct,
  round(100.0 * (count(*) - count_if(status = 'success')) / count(*), 6) AS error_pct FROM {RES}""")
def q_dashboard(spark, d):
    t = R.dashboard(fx.results_fx(spark, d))
    return t.select("total", "success", "errors", r6("avg_time_ms"), r6("success_pct"), r6("error_pct"))


@register("cost_estimate", f"""
SELECT r.model, CAST(r.documents AS BIGINT) AS documents, CAST(r.documents * 1000 AS BIGINT) AS estimated_tokens,
  p.price_per_1k, round(r.documents * 1000 / 1000.0 * p.price_per_1k, 6) AS estimated_cost
FROM (SELECT model, count_if(status = 'success') AS documents FROM {RES} GROUP BY 1) r
LEFT JOIN {PRICES} p ON r.model = p.model""")
def q_cost_estimate(spark, d):
    c = R.cost_estimate(fx.results_fx(spark, d), S.model_prices(spark))
    return c.select("model", "documents", "estimated_tokens", "price_per_1k", r6("estimated_cost"))


@register("throughput", f"""
SELECT CAST(count(*) AS BIGINT) AS documents, round((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6, 6)
  AS elapsed_s, round(count(*) / ((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6), 6) AS docs_per_s
FROM {RES}""")
def q_throughput(spark, d):
    t = R.throughput(fx.results_fx(spark, d))
    return t.select("documents", r6("elapsed_s"), r6("docs_per_s"))


@register("batch_outcome", f"""
SELECT status, CASE WHEN count(*) > 0 AND count_if(status <> 'success') = 0 THEN 0 ELSE 1 END AS exit_code
FROM {RES} GROUP BY status""")
def q_batch_outcome(spark, d):
    return R.batch_outcome(fx.results_fx(spark, d), by=["status"])


@register("model_availability", f"""
SELECT status, CAST(count(DISTINCT model) AS BIGINT) AS models, string_agg(DISTINCT model, ',' ORDER BY model)
  AS model_names FROM {RES} GROUP BY status""")
def q_model_availability(spark, d):
    return R.model_availability(fx.results_fx(spark, d))


@register("model_benchmark", f"""
SELECT model, CAST(count(*) AS BIGINT) AS runs, round(avg(processing_time_ms), 6) AS mean_time_ms,
  round(avg(CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END), 6) AS success_rate,
  min(confidence) AS min_score, max(confidence) AS max_score FROM {RES} GROUP BY model""")
def q_model_benchmark(spark, d):
    b = R.model_benchmark(fx.results_fx(spark, d))
    return b.select("model", "runs", r6("mean_time_ms"), r6("success_rate"), "min_score", "max_score")


@register("fastest_model", f"""
SELECT model, round(avg(processing_time_ms), 6) AS mean_time_ms FROM {RES} WHERE processing_time_ms IS NOT NULL
GROUP BY model ORDER BY avg(processing_time_ms), model LIMIT 1""")
def q_fastest_model(spark, d):
    return R.fastest_model(fx.results_fx(spark, d)).select("model", r6("mean_time_ms"))


@register("working_models", f"""
SELECT DISTINCT model FROM {RES} WHERE status = 'success' ORDER BY model LIMIT 3""")
def q_working_models(spark, d):
    return R.first_working_models(fx.results_fx(spark, d), 3)


@register("max_docs", f"""
SELECT request_key FROM {REQ} ORDER BY source, request_key LIMIT 25""")
def q_max_docs(spark, d):
    return R.max_docs(fx.requests_fx(spark, d), 25, order=["source", "request_key"]).select("request_key")


@register("chunk", f"""
SELECT request_key FROM {REQ} ORDER BY source, request_key LIMIT 20 OFFSET 10""")
def q_chunk(spark, d):
    return R.chunk(fx.requests_fx(spark, d), 10, 20, order=["source", "request_key"]).select("request_key")


@register("half_in_order", f"""
SELECT request_key, position FROM (
  SELECT request_key, row_number() OVER (ORDER BY source, request_key) - 1 AS position, count(*) OVER () AS n FROM {REQ})
WHERE position >= n // 4 AND position < n // 4 + n // 2""")
def q_half_in_order(spark, d):
    """Half of all requests by their positions, a quarter skipped: no task holds them all."""
    req = fx.requests_fx(spark, d).select("source", "request_key")
    n = req.count()
    return K.take(K.with_position(req, ["source", "request_key"]), n // 4, n // 2, ["source", "request_key"]).select(
        "request_key", "position")


@register("retry_list", f"""
SELECT source AS value FROM {RES} WHERE status <> 'success'""")
def q_retry_list(spark, d):
    return R.retry_list(fx.results_fx(spark, d))


@register("union_sources", f"""
SELECT document_id, source, source_type,
  CASE WHEN source_type = 's3' THEN split_part(substring(source, 6), '/', 1) END AS bucket,
  CASE WHEN source_type = 's3' THEN lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.' || ext END AS key,
  CASE WHEN source_type = 'local' THEN source END AS file_path
FROM {REQ} WHERE source_type IN ('s3', 'local')""")
def q_union_sources(spark, d):
    lines = fx.requests_fx(spark, d).where(F.col("source_type").isin("s3", "local")).select(F.col("source").alias("value"))
    return D.parse_file_list_lines(lines).select("document_id", "source", "source_type", "bucket", "key", "file_path")


@register("batch_summary", f"""
SELECT 'total' AS level, CAST(NULL AS VARCHAR) AS document_type, CAST(count(*) AS BIGINT) AS n,
  CAST(count_if(status = 'success') AS BIGINT) AS successful, CAST(count_if(status = 'error') AS BIGINT) AS errors,
  CAST(count_if(status = 'timeout') AS BIGINT) AS timeouts, round(coalesce(avg(processing_time_ms), 0), 6) AS avg_time_ms,
  CAST(count_if(status = 'success' AND coalesce(confidence, 0) >= 0.8) AS BIGINT) AS high,
  CAST(count_if(status = 'success' AND coalesce(confidence, 0) >= 0.5 AND coalesce(confidence, 0) < 0.8) AS BIGINT)
    AS medium,
  CAST(count_if(status = 'success' AND coalesce(confidence, 0) < 0.5) AS BIGINT) AS low FROM {RES}
UNION ALL
SELECT 'type', coalesce(document_type, 'unknown'), CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT), 0, 0,
  round(coalesce(avg(processing_time_ms), 0), 6),
  CAST(count_if(coalesce(confidence, 0) >= 0.8) AS BIGINT),
  CAST(count_if(coalesce(confidence, 0) >= 0.5 AND coalesce(confidence, 0) < 0.8) AS BIGINT),
  CAST(count_if(coalesce(confidence, 0) < 0.5) AS BIGINT)
FROM {RES} WHERE status = 'success' GROUP BY 2""")
def q_batch_summary(spark, d):
    return R.batch_summary(fx.results_fx(spark, d)).withColumn("avg_time_ms", F.round("avg_time_ms", 6))


@register("hash_chunks", f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT request_key) AS BIGINT) AS keys,
  CAST(4 AS BIGINT) AS chunks FROM {REQ}""")
def q_hash_chunks(spark, d):
    """All four hash chunks of the requests: disjoint and together complete (G2 at scale)."""
    req = fx.requests_fx(spark, d)
    parts = [R.hash_chunk(req, 4, i).withColumn("chunk", F.lit(i)) for i in range(4)]
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    return allp.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("request_key").alias("keys"),
                    F.countDistinct("chunk").alias("chunks"))
