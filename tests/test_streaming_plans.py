"""Stream equals batch (J1), per-batch counts (J2), plan properties and the driver contract."""

import __spark_entry__ as se
from pyspark.sql import functions as F

from doctriage.operators import catalog as CAT
from doctriage.plans import fixtures as fx
from doctriage.plans import registry

SF001 = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark):
    cols = ["request_key", "status", "stage", "predicted_type", "primary_score"]
    s = registry.QUERIES["stream_classify"](spark, SF001).select(*cols)
    b = registry.QUERIES["classify_batch"](spark, SF001).select(*cols)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, b.collect()))


def test_stream_batch_counts(spark):
    out = registry.QUERIES["stream_batch_counts"](spark, SF001).first()
    assert out.several_batches and out.processed == fx.requests_fx(spark, SF001).count()


def test_dimension_lookups_are_broadcast(spark):
    plan = CAT.with_model_alias(fx.results_fx(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_scan_pushdown_and_pruning(spark):
    df = fx.results_fx(spark, SF001).where("status = 'error'").select("document_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan  # 2 of 6 columns read
    df2 = fx.results_fx(spark, SF001).where("event_id < 100").select("document_id")
    plan2 = df2._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(event_id,100)" in plan2


def test_entry_and_contract(spark):
    out = se.entry(spark).collect()
    assert out and set(out[0].asDict()) == {"document_type", "n", "share_pct"}
    assert set(se.oracle_sql()) <= set(se.queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lexicon_regex_path_is_narrow(spark):
    from pyspark.sql import functions as F

    from doctriage.operators.score import lexicon_score
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    plan = _plan(lexicon_score(docs, fx.LEXICON_ROWS).select("doc_id", "predicted_type", F.size("key_terms")))
    assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_classification_shuffles_only_on_request_key(spark):
    from doctriage.operators.score import classify, recorded_scorer
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        res = classify(fx.requests_fx(spark, SF001), recorded_scorer(fx.answers_fx(spark, SF001)))
        plan = _plan(res.select("request_key", "predicted_type", "status"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert len(exchanges) == 2 and all("request_key" in ln for ln in exchanges)
    assert "SortMergeJoin" in plan and "ArrowEvalPython" in plan
    # the document text is never read when the answers are recorded
    assert "text:string" not in plan


def test_reports_aggregate_partially(spark):
    from doctriage.operators import reports as R
    plan = _plan(R.model_benchmark(fx.results_fx(spark, SF001)))
    assert plan.count("HashAggregate") >= 2  # partial (map side) + final


def test_answer_parser_runs_once_under_filters(spark):
    # a filter on a parsed column must not evaluate the Python parser a second time
    plan = _plan(registry.QUERIES["type_distribution"](spark, SF001))
    assert plan.count("ArrowEvalPython") == 1


def test_whole_texts_do_not_enter_the_scorer(spark):
    plan = _plan(registry.QUERIES["classify_callable"](spark, SF001))
    scorer_line = [ln for ln in plan.splitlines() if "MapInPandas" in ln][0]
    import re
    assert "prompt#" in scorer_line and "document_content" not in scorer_line
    assert not re.search(r"(?<![\w])text#", scorer_line)  # the raw text column (response_text is fine)


def test_stream_results_and_counts_once(spark, tmp_path):
    from doctriage.operators.score import function_scorer
    from doctriage.streaming.queue import classify_stream, read_messages, results_and_counts_writer
    src = tmp_path / "msgs"
    body = '{"document_uri": "direct://text-input", "document_id": "d%d", "document_content": "text %d"}'
    spark.createDataFrame([(body % (i, i),) for i in range(9)], "body string").repartition(3).write.json(str(src))
    calls = spark.sparkContext.accumulator(0)

    def fn(prompt):
        calls.add(1)
        return '{"predicted_type": "memo", "confidence_score": 0.9}'

    res = classify_stream(read_messages(spark, str(src), max_files_per_trigger=1), function_scorer(fn))
    q = (res.writeStream.foreachBatch(results_and_counts_writer(str(tmp_path / "res"), str(tmp_path / "cnt")))
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    counts = spark.read.parquet(str(tmp_path / "cnt"))
    assert counts.agg(F.sum("processed")).first()[0] == 9 and counts.count() >= 2
    assert spark.read.parquet(str(tmp_path / "res")).count() == 9
    assert calls.value == 9


def test_hour_partitioned_write_rebalances(spark):
    from doctriage.sinks import writers as W
    res = W.batch_records(fx.results_fx(spark, SF001)).withColumn("ts", F.to_timestamp("timestamp"))
    t = W.utc_wall(F.col("ts"))
    d = res.withColumns({"year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"),
                         "day": F.date_format(t, "dd"), "hour": F.date_format(t, "HH")})
    plan = d.hint("rebalance", "year", "month", "day", "hour")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    import inspect
    assert 'hint("rebalance"' in inspect.getsource(W.write_by_hour)
