"""Batch reports over result rows.

Input is a batch-results DataFrame with (by default) the columns ``status``,
``document_type``, ``confidence``, ``processing_time_ms``, ``model``,
``timestamp`` and ``source``.  Every report is a partial + final hash
aggregation; the only single-partition steps run on already-aggregated rows
whose count is bounded by the number of types or models.  Percentages and means
are emitted unrounded; divisions by an empty total give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.confidence import _ge
from .ranking import take


MAX_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for a dimension whose row count is checked to be within ``max_rows``.

    The check is a bounded count (``limit(max_rows + 1)``), cheap for the small
    local tables it is meant for; above the bound Spark keeps its own choice.
    """
    return F.broadcast(dim) if dim.limit(max_rows + 1).count() <= max_rows else dim


def _success(status: str = "status") -> Column:
    return F.col(status) == "success"


def _pct(part: Column, total: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), total)


def batch_totals(df: DataFrame, status: str = "status") -> DataFrame:
    """Rows, successes, errors, timeouts and their shares of all rows."""
    s = F.col(status)
    agg = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "success").alias("successful"),
        F.count_if(s == "error").alias("errors"),
        F.count_if(s == "timeout").alias("timeouts"),
    )
    return agg.withColumns({
        "success_pct": _pct(F.col("successful"), F.col("total")),
        "error_pct": _pct(F.col("errors"), F.col("total")),
        "timeout_pct": _pct(F.col("timeouts"), F.col("total")),
    })


def batch_summary(df: DataFrame, status: str = "status", type_col: str = "document_type",
                  score: str = "confidence", ms: str = "processing_time_ms") -> DataFrame:
    """F1-F4 in one scan: grouping sets ``()`` and ``(type)`` (type only on successes).

    Rows with ``level = 'total'`` carry the batch totals, mean time and bands;
    ``level = 'type'`` rows carry the per-type success counts (and their bands).
    """
    ok = _success(status)
    c = F.coalesce(F.col(score), F.lit(0.0))
    key = F.when(ok, F.coalesce(F.col(type_col), F.lit("unknown"))).alias("__type")
    g = df.select(key, F.col(status).alias("__s"), c.alias("__c"), F.col(ms).alias("__ms")).groupingSets(
        [[], ["__type"]], "__type")
    s = F.col("__s")
    out = g.agg(
        F.grouping_id().alias("__gid"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(s == "success").alias("successful"),
        F.count_if(s == "error").alias("errors"),
        F.count_if(s == "timeout").alias("timeouts"),
        F.coalesce(F.avg("__ms"), F.lit(0.0)).alias("avg_time_ms"),
        F.count_if((s == "success") & _ge(F.col("__c"), 0.8)).alias("high"),
        F.count_if((s == "success") & ~_ge(F.col("__c"), 0.8) & _ge(F.col("__c"), 0.5)).alias("medium"),
        F.count_if((s == "success") & ~_ge(F.col("__c"), 0.5)).alias("low"),
    )
    # the (type) set also forms a group for non-success rows (type NULL); drop it
    out = out.where((F.col("__gid") == 1) | F.col("__type").isNotNull())
    return out.select(F.when(F.col("__gid") == 1, F.lit("total")).otherwise(F.lit("type")).alias("level"),
                      F.col("__type").alias("document_type"), "n", "successful", "errors", "timeouts",
                      "avg_time_ms", "high", "medium", "low")


def avg_time(df: DataFrame, ms: str = "processing_time_ms") -> DataFrame:
    """Mean time over rows that have one, all statuses; 0 when none (F2)."""
    return df.agg(F.coalesce(F.avg(ms), F.lit(0.0)).alias("avg_time_ms"))


def type_distribution(df: DataFrame, status: str = "status", type_col: str = "document_type") -> DataFrame:
    """Count per type among successes and share of successes, largest first.

    The share uses a window over the aggregated rows (one per type), not over the
    input rows.
    """
    counts = (df.where(_success(status))
              .groupBy(F.coalesce(F.col(type_col), F.lit("unknown")).alias("document_type"))
              .agg(F.count(F.lit(1)).alias("n")))
    total = F.sum("n").over(Window.partitionBy())
    return (counts.withColumn("share_pct", _pct(F.col("n"), total))
            .orderBy(F.desc("n"), F.asc("document_type")))


def confidence_bands(df: DataFrame, status: str = "status", score: str = "confidence") -> DataFrame:
    """Successes banded >= 0.8 high, >= 0.5 medium, rest low; missing score counts as 0."""
    c = F.coalesce(F.col(score), F.lit(0.0))
    ok = _success(status)
    return df.agg(
        F.count_if(ok & _ge(c, 0.8)).alias("high"),
        F.count_if(ok & ~_ge(c, 0.8) & _ge(c, 0.5)).alias("medium"),
        F.count_if(ok & ~_ge(c, 0.5)).alias("low"),
    )


def report_bands(df: DataFrame, status: str = "status", type_col: str = "document_type",
                 score: str = "confidence") -> DataFrame:
    """Report bands with strict bounds: > 0.8, > 0.5, rest; successes with a type."""
    c = F.coalesce(F.col(score), F.lit(0.0))
    ok = _success(status) & F.col(type_col).isNotNull()
    gt8 = (c > 0.8) & ~F.isnan(c)
    gt5 = (c > 0.5) & ~F.isnan(c)
    return df.agg(
        F.count_if(ok & gt8).alias("high_confidence"),
        F.count_if(ok & ~gt8 & gt5).alias("medium_confidence"),
        F.count_if(ok & ~gt5).alias("low_confidence"),
    )


def report_totals(df: DataFrame, status: str = "status") -> DataFrame:
    """Processed, success and not-success counts."""
    return df.agg(
        F.count(F.lit(1)).alias("processed_count"),
        F.count_if(_success(status)).alias("success_count"),
        F.count_if(~_success(status) | F.col(status).isNull()).alias("error_count"),
    )


MAP_TYPES = 1000        # entries of a report's type map
OTHER_TYPES = "(other types)"


def report_types(df: DataFrame, status: str = "status", type_col: str = "document_type", most: int = MAP_TYPES) -> DataFrame:
    """One row holding ``document_types`` as a map type -> count.

    All counts are exact.  Free-text types may be very many: the map holds the ``most`` frequent
    ones (ties by name), and the documents of all others under ``(other types)``.
    """
    counts = (df.where(_success(status) & F.col(type_col).isNotNull())
              .groupBy(type_col).agg(F.count(F.lit(1)).alias("n")))
    top = counts.orderBy(F.desc("n"), type_col).limit(most)  # a top-k: each task keeps so many
    listed = top.agg(F.array_sort(F.collect_list(F.struct(F.col(type_col), F.col("n")))).alias("top"), F.sum("n").alias("listed"))
    whole = counts.agg(F.sum("n").alias("whole"))
    rest = F.coalesce(F.col("whole"), F.lit(0)) - F.coalesce(F.col("listed"), F.lit(0))
    other = F.when(rest > 0, F.array(F.struct(F.lit(OTHER_TYPES).alias(type_col), rest.alias("n"))))
    entries = F.concat("top", F.coalesce(other, F.slice("top", 1, 0)))
    # both sides are one row
    return listed.withColumn("one", F.lit(1)).join(whole.withColumn("one", F.lit(1)), "one").select(
        F.map_from_entries(entries).alias("document_types"))


def batch_report(df: DataFrame, status: str = "status", type_col: str = "document_type",
                 score: str = "confidence") -> DataFrame:
    """The batch report record: summary, type map and strict bands in one row.

    The counts are one partial and final aggregate; the type map is that of ``report_types``, whose
    entries are bounded whatever the types.
    """
    c = F.coalesce(F.col(score), F.lit(0.0))
    ok = _success(status) & F.col(type_col).isNotNull()
    gt8 = (c > 0.8) & ~F.isnan(c)
    gt5 = (c > 0.5) & ~F.isnan(c)
    one = df.agg(
        F.count(F.lit(1)).alias("processed_count"),
        F.count_if(_success(status)).alias("success_count"),
        F.count_if(ok & gt8).alias("high_confidence"),
        F.count_if(ok & ~gt8 & gt5).alias("medium_confidence"),
        F.count_if(ok & ~gt5).alias("low_confidence"),
    )
    # both are one row
    one = one.withColumn("one", F.lit(1)).join(report_types(df, status, type_col).withColumn("one", F.lit(1)), "one")
    return one.select(
        F.struct("processed_count", F.current_timestamp().alias("timestamp"), "success_count",
                 (F.col("processed_count") - F.col("success_count")).alias("error_count")
                 ).alias("batch_summary"),
        "document_types",
        F.struct("high_confidence", "medium_confidence", "low_confidence").alias("confidence_stats"),
    )


def dashboard(df: DataFrame, status: str = "status", ms: str = "processing_time_ms") -> DataFrame:
    """Total, success, errors = total - success (timeouts included), mean time with missing as 0 (F8)."""
    agg = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_success(status)).alias("success"),
        F.try_divide(F.sum(F.coalesce(F.col(ms), F.lit(0.0))), F.count(F.lit(1))).alias("avg_time_ms"),
    )
    return agg.withColumns({
        "errors": F.col("total") - F.col("success"),
        "success_pct": _pct(F.col("success"), F.col("total")),
        "error_pct": _pct(F.col("total") - F.col("success"), F.col("total")),
    })


def cost_estimate(df: DataFrame, prices: DataFrame, status: str = "status", model: str = "model",
                  tokens_per_doc: int = 1000) -> DataFrame:
    """Per model: successes x tokens_per_doc x price / 1000; NULL cost when unpriced.

    The price table is a fixed-size dimension and is broadcast; the join happens
    after aggregation, on one row per model.
    """
    per = df.groupBy(model).agg(F.count_if(_success(status)).alias("documents"))
    per = per.withColumn("estimated_tokens", F.col("documents") * F.lit(tokens_per_doc))
    j = per.join(broadcast_if_small(prices), model, "left")
    return j.withColumn("estimated_cost", F.col("estimated_tokens") / 1000.0 * F.col("price_per_1k"))


def throughput(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Documents per second between the first and last result timestamps."""
    span = (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / 1e6
    return df.agg(F.count(F.lit(1)).alias("documents"), span.alias("elapsed_s"),
                  F.try_divide(F.count(F.lit(1)), span).alias("docs_per_s"))


def batch_outcome(df: DataFrame, status: str = "status", by: list[str] | None = None) -> DataFrame:
    """0 when every row succeeded, 1 otherwise; 1 also for an empty batch.

    ``by`` gives one outcome per group (e.g. per source or per run).
    """
    code = F.when((F.count(F.lit(1)) > 0) & (F.count_if(~_success(status) | F.col(status).isNull()) == 0),
                  F.lit(0)).otherwise(F.lit(1)).alias("exit_code")
    return df.groupBy(*by).agg(code) if by else df.agg(code)


def model_availability(df: DataFrame, status: str = "status", model: str = "model") -> DataFrame:
    """Per status: number of models and their names.

    ``collect_set`` is bounded by the number of distinct models, and is combined
    map-side before the shuffle.
    """
    per = df.groupBy(status).agg(F.collect_set(model).alias("__m"))  # one aggregation, one shuffle
    return per.select(status, F.size("__m").cast("bigint").alias("models"),
                      F.array_join(F.array_sort("__m"), ",").alias("model_names"))


def model_benchmark(df: DataFrame, status: str = "status", model: str = "model",
                    ms: str = "processing_time_ms", score: str = "confidence") -> DataFrame:
    """Per model: mean time, success rate and score range."""
    return df.groupBy(model).agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg(ms).alias("mean_time_ms"),
        F.avg(_success(status).cast("double")).alias("success_rate"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )


def fastest_model(df: DataFrame, model: str = "model", ms: str = "processing_time_ms") -> DataFrame:
    """Model with the lowest mean time; ties by name."""
    per = df.where(F.col(ms).isNotNull()).groupBy(model).agg(F.avg(ms).alias("mean_time_ms"))
    return per.orderBy("mean_time_ms", model).limit(1)


def first_working_models(df: DataFrame, n: int = 3, status: str = "status", model: str = "model") -> DataFrame:
    """The first ``n`` models (by name) that have at least one success."""
    return (df.where(_success(status)).select(model).distinct().orderBy(model).limit(n))


TOP_K = 10_000  # rows up to which an ordered limit is a top-k; more are taken by their positions


def max_docs(df: DataFrame, n: int | None, order: str | list[str] = "source") -> DataFrame:
    """At most ``n`` rows in ``order``; None or 0 means no limit."""
    return chunk(df, 0, n, order) if n else df


def chunk(df: DataFrame, skip: int, n: int, order: str | list[str] = "source") -> DataFrame:
    """Skip ``skip`` rows, take ``n``.

    Up to ``TOP_K`` rows in all this is a top-k; beyond, a filter on positions in a range sort
    (``ranking.take``), where no task holds them all.
    """
    if skip < 0 or n < 0:
        raise ValueError("skip and n must not be negative")
    if skip + n <= TOP_K:
        return df.orderBy(order).offset(skip).limit(n)
    return take(df, skip, n, order)


def hash_chunk(df: DataFrame, chunks: int, index: int, key: str = "request_key") -> DataFrame:
    """Chunk ``index`` of ``chunks`` by a hash of ``key``: the scalable way to process a batch in parts.

    ``chunk``/``max_docs`` keep an order, which costs a sort where they are large.  Hash chunks
    need none: every chunk is a filter on the scan, the chunks are disjoint and together cover every row.
    """
    if not 0 <= index < chunks:
        raise ValueError("index must be in [0, chunks)")
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(chunks)) == index)


def retry_list(df: DataFrame, status: str = "status", source: str = "source") -> DataFrame:
    """URIs/paths of rows that did not succeed, as a ``value`` column for a text sink."""
    return df.where(~_success(status) | F.col(status).isNull()).select(F.col(source).alias("value"))


def flat_results(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Classified rows as flat records with their derived fields (D19); ``keep`` carries further columns."""
    from ..functions.confidence import confidence_level, is_high_confidence, needs_review
    from .extract import extraction_failed
    return df.select(
        *(keep or []), "document_id", F.col("predicted_type").alias("document_type"), F.col("primary_score").alias("confidence"),
        confidence_level("primary_score").alias("confidence_level"), is_high_confidence("primary_score").alias("high_confidence"),
        needs_review("primary_score", "threshold").alias("needs_review"), "reasoning",
        extraction_failed("reasoning", "predicted_type").alias("extraction_failed"))


def review_queue(df: DataFrame, score: str = "primary_score", threshold: str = "threshold") -> DataFrame:
    """Rows that need human review, lowest score first, then by key: a score that many share is split."""
    from ..functions.confidence import needs_review
    return df.where(needs_review(score, threshold)).orderBy(F.asc(score), *(["request_key"] if "request_key" in df.columns else []))


def expectation_check(results: DataFrame, expected: DataFrame | None, key: str,
                      type_col: str = "predicted_type", score: str = "primary_score",
                      expected_type: str = "expected_type", ceiling: str = "score_ceiling") -> DataFrame:
    """Results joined with expectations: type match and score under a ceiling.

    Pass ``expected=None`` when the expectations were joined onto the requests
    before classification: that join then shares the request-key partitioning
    with the answer pairing, whereas a join after the Python parser must
    re-shuffle the results (a Python stage does not keep its input's partitioning).
    """
    j = results if expected is None else results.join(expected, key, "inner")
    return j.withColumns({
        "type_matches": F.col(type_col) == F.col(expected_type),
        "under_ceiling": F.when(F.col(ceiling).isNotNull(), F.col(score) < F.col(ceiling)),
    })


def case_model_matrix(cases: DataFrame, models: list[str], model_col: str = "model") -> DataFrame:
    """Every case paired with each of a short, fixed list of models.

    The model list is a driver-side parameter of bounded length, expanded with
    ``explode`` of a literal array: linear in the cases, no join.
    """
    return cases.withColumn(model_col, F.explode(F.array(*[F.lit(m) for m in models])))


def observe_batch(df: DataFrame, status: str = "status", ts: str = "timestamp"):
    """Attach batch metrics to ``df`` that are filled by whatever action runs it.

    Returns ``(observed_df, observation)``; after e.g. writing the results,
    ``observation.get`` holds totals and the time span without a second pass.
    """
    from pyspark.sql import Observation
    obs = Observation("doctriage_batch")
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("total"),
        F.count_if(_success(status)).alias("successful"),
        F.count_if(F.col(status) == "error").alias("errors"),
        F.count_if(F.col(status) == "timeout").alias("timeouts"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )
    return observed, obs
