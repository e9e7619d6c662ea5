"""Whole prompts, quoting, odd answers and records, thresholds, queue messages, limits and hot keys."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from doctriage.functions.answer_json import describe_answer
from doctriage.functions.text import build_prompt
from doctriage.operators.parse import parse_response
from doctriage.operators.reports import review_queue
from doctriage.functions.results import result_from_json
from doctriage.operators.score import (classify, classify_to_table, function_scorer, lexicon_score, lexicon_score_join,
                                       recorded_scorer)
from doctriage.plans.batch import run_batch
from doctriage.sinks import writers as W
from doctriage.sources.discover import conform, list_store, read_file_list_csv
from doctriage.streaming.queue import classify_stream, messages_to_requests, results_and_counts_writer


def test_prompt_holds_the_whole_text(spark):
    df = spark.createDataFrame([("x" * 50_000,)], "t string")
    whole, cut = df.select(F.length(build_prompt("t")), F.length(build_prompt("t", limit=3000))).first()
    assert whole - cut == 47_000


def test_csv_list_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "list.csv"
    rows = [["a", 'He said "hi", ok'], ["b", "two\nlines"], ["c", "back\\slash"]]
    with path.open("w", newline="") as f:
        csv.writer(f).writerows([["document_id", "text"], *rows])
    got = read_file_list_csv(spark, str(path)).select("document_id", "text").collect()
    assert sorted(map(list, got)) == rows


def test_summary_csv_is_standard(spark, tmp_path):
    df = spark.createDataFrame([('d"1\\', "s,\"x\"", "success", "invoice", 0.9, 5.0, None)],
                               "document_id string, source string, status string, document_type string, "
                               "confidence double, processing_time_ms double, timestamp timestamp")
    W.write_summary_csv(df, str(tmp_path / "out"))
    rows = []
    for part in (tmp_path / "out").glob("*.csv"):  # a part may hold the header alone
        with part.open(newline="") as f:
            rows += csv.DictReader(f)
    [row] = rows
    assert (row["document_id"], row["source"], row["document_type"]) == ('d"1\\', 's,"x"', "invoice")


@pytest.mark.parametrize("answer,kind", [
    ('{"predicted_type": "memo", "reasoning": "a \\ud800 b"}', "ok"),
    ('{"predicted_type": "memo", "confidence_score": ' + "9" * 5000 + "}", "parse"),
    ('so: {"predicted_type": "memo", "confidence_score": 0.8, "extracted_features": {"a": {"b": {"c": {"d": 1}}}}}', "ok"),
])
def test_odd_answers(spark, answer, kind):
    assert describe_answer(answer)[0] == kind
    row = parse_response(spark.createDataFrame([(answer,)], "response_text string"), "response_text").first()
    assert (row.stage == "parse") == (kind == "parse")
    if kind == "ok":
        assert row.predicted_type == "memo"


def test_records_follow_the_threshold(spark):
    df = spark.createDataFrame([("d", "s", "success", "memo", 0.85, "r", 1.0, None, True)],
                               "document_id string, source string, status string, document_type string, confidence double, "
                               "reasoning string, processing_time_ms double, timestamp timestamp, extraction_failed boolean") \
        .withColumn("error", F.lit(None).cast("string"))
    flags = [W.batch_records(df, t).first().classification for t in (0.7, 0.95)]
    assert [f.needs_review for f in flags] == [False, True] and flags[0].extraction_failed


def test_bad_messages_are_error_rows(spark):
    bodies = [("not json",), (json.dumps({"document_uri": "direct://x", "document_id": "1", "document_content": "t"}),),
              (json.dumps({"document_id": "2"}),), (None,)]
    df = spark.createDataFrame(bodies, "body string")
    assert messages_to_requests(df).filter("request_key is null").count() == 0
    answers = spark.createDataFrame([("direct://x#1", '{"predicted_type": "memo", "confidence_score": 0.9}')],
                                    "request_key string, response_text string")
    rows = classify_stream(df, recorded_scorer(answers)).collect()
    assert sorted((r.status, r.predicted_type) for r in rows)[-1] == ("success", "memo")
    assert [r.status for r in rows].count("error") == 3 and all(r.error for r in rows if r.status == "error")


def test_empty_micro_batch_counts_zero(spark, tmp_path):
    write = results_and_counts_writer(str(tmp_path / "rows"), str(tmp_path / "counts"))
    full = spark.createDataFrame([("k", "success"), ("l", "error")], "request_key string, status string")
    write(full.limit(0), 0)
    write(full, 1)
    write(full.limit(0), 2)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "counts")).select("batch_id", "processed", "succeeded").collect()))
    assert got == [(0, 0, 0), (1, 2, 1), (2, 0, 0)]


def test_review_queue_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(f"k{i}", 0.0, 0.7) for i in range(20)], "request_key string, primary_score double, threshold double")
    assert [r.request_key for r in review_queue(df).collect()] == sorted(f"k{i}" for i in range(20))


@pytest.mark.parametrize("as_table", [False, True])
def test_lexicon_paths_agree_on_repeated_rows(spark, as_table):
    rows = [("a", "apple", 1.0), ("a", "apple", 1.0), ("b", "zebra", 3.0), (None, "apple", 9.0)]
    docs = spark.createDataFrame([(1, "zebra apple apple", "x"), (2, "none", None), (3, None, "y")],
                                 "doc_id int, text string, note string")
    table = spark.createDataFrame(rows, "document_type string, term string, weight double")
    got = [lexicon_score(docs, table if as_table else rows), lexicon_score(docs, rows, max_inline_groups=0),
           lexicon_score_join(docs, table)]
    assert len({tuple(g.columns) for g in got}) == 1 and "text" not in got[0].columns
    first, *others = [sorted(map(str, g.collect())) for g in got]
    assert all(o == first for o in others)
    best = got[0].where("doc_id = 1").first()
    assert (best.predicted_type, best.primary_score, best.evidence, best.key_terms) == ("a", 4 / 7, 7.0, ["apple", "zebra"])


def test_waiting_for_the_rate_is_no_timeout(spark):
    req = spark.createDataFrame([(str(i), f"k{i}", "t") for i in range(4)],
                                "document_id string, request_key string, document_content string")
    calls = spark.sparkContext.accumulator(0)

    def fn(prompt):
        calls.add(1)
        return '{"predicted_type": "memo", "confidence_score": 0.6}'

    scorer = function_scorer(fn, partitions=1, threads_per_task=4, max_calls_per_minute=120, timeout_s=0.4, hard_timeout=True)
    assert [r.status for r in classify(req, scorer).collect()] == ["success"] * 4 and calls.value == 4


def test_repeated_and_missing_keys_are_paid_once_or_not(spark, tmp_path):
    schema = "document_id string, request_key string, document_content string"
    req = spark.createDataFrame([("1", "a", "t"), ("1", "a", "t"), ("2", "b", "t")], schema)
    calls = spark.sparkContext.accumulator(0)

    def fn(prompt):
        calls.add(1)
        return '{"predicted_type": "memo", "confidence_score": 0.6}'

    path = str(tmp_path / "table")
    for _ in range(2):
        assert classify_to_table(req, function_scorer(fn), path).count() == 2
    with pytest.raises(ValueError):
        classify_to_table(spark.createDataFrame([("3", None, "t")], schema), function_scorer(fn), path)
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        classify_to_table(req, function_scorer(fn), str(broken))
    assert calls.value == 2


def test_records_with_odd_scores_say_so(spark):
    def record(score):
        return '{"document_id": "d", "predicted_type": "memo", "confidence": {"primary_score": %s}}' % score
    rows = [("text", record('"abc"')), ("quoted", record('"0.9"')), ("number", record("0.9")), ("whole", record("1")),
            ("null", record("null")), ("high", record("1.5")), ("none", "not json"), ("list", "[1]"), ("empty", "{}"),
            ("missing", None)]
    got = {r.name: r.record_error for r in result_from_json(spark.createDataFrame(rows, "name string, j string"), "j").collect()}
    number, whole = "Primary score is not a number", "Record is not a JSON object"
    assert got == {"text": number, "quoted": number, "number": None, "whole": None, "null": None,
                   "high": "Primary score must be between 0.0 and 1.0", "none": whole, "list": whole, "missing": whole,
                   "empty": "Document ID is required"}


def test_unknown_kinds_and_oversized_files_are_error_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "small.txt").write_text("hi")
    (tmp_path / "in" / "big.txt").write_text("x" * 100)
    docs = list_store(spark, str(tmp_path / "in"), max_size_bytes=50, extract=True)
    odd = conform(spark.createDataFrame([("f", "ftp://x", "ftp")], "document_id string, source string, source_type string"))
    sent = spark.sparkContext.accumulator(0)

    def fn(prompt):
        sent.add(1)
        return '{"predicted_type": "memo", "confidence_score": 0.6}'

    records, _, _ = run_batch(docs.unionByName(odd, allowMissingColumns=True), function_scorer(fn), "m",
                              extracted_col="extracted", extraction_error_col="extraction_error")
    got = {r.document_id: (r.status, r.error) for r in records.collect()}
    assert got["small"][0] == "success" and sent.value == 1
    assert got["big"] == ("error", "File too large: 100 bytes, limit 50")
    assert got["f"] == ("error", "Unsupported source type: ftp")


def test_a_hot_key_is_split(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in zip(keys, ("-1", "64k", "64k", "-1")):
            spark.conf.set(k, v)
        ids = spark.range(0, 200_000, numPartitions=8)
        req = ids.select(F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("request_key"),
                         F.md5(F.col("id").cast("string")).alias("prompt"))
        answers = ids.select(F.col("id").cast("string").alias("request_key"), F.lit("{}").alias("response_text")) \
            .union(spark.createDataFrame([("hot", "{}")] * 3, "a string, b string"))
        out = recorded_scorer(answers)(req)
        assert len(out.collect()) == 200_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
