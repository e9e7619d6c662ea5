"""Positions, bounded type maps, chosen answers."""

import random

from pyspark.sql import functions as F

from doctriage.operators import ranking as K
from doctriage.operators import reports as R
from doctriage.operators.score import recorded_scorer


def test_positions_and_takes(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("aab") * 3, rnd.randint(0, 50)) for _ in range(3000)] + [(None, 1)] * 40
    df = spark.createDataFrame(rows, "s string, n int").repartition(7)
    got = K.with_position(df, ["s", "n"]).collect()
    order = lambda r: (r[0] is not None, r[0] or "", r[1])
    assert sorted(r.position for r in got) == list(range(len(rows)))
    assert [order((r.s, r.n)) for r in sorted(got, key=lambda r: r.position)] == sorted(map(order, rows))
    half = K.take(df, 700, 1500, ["s", "n"]).collect()
    assert sorted(order((r.s, r.n)) for r in half) == sorted(map(order, rows))[700:2200]
    assert K.take(df, 3000, None, ["s", "n"]).count() == 40 and K.take(df, 5000, 10, "s").count() == 0
    assert K.take(df.limit(0), 0, 10, "s").count() == 0


def test_large_chunks_are_no_top_k(spark):
    df = spark.range(40_000).select(F.col("id").alias("source"))
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    small, large = R.chunk(df, 5, 10), R.chunk(df, 10_000, 20_000)
    assert "TakeOrdered" in plan(small) or "CollectLimit" in plan(small)
    assert "TakeOrdered" not in plan(large) and "GlobalLimit" not in plan(large)
    assert large.agg(F.min("source"), F.max("source"), F.count("*")).first()[:] == (10_000, 29_999, 20_000)
    assert R.max_docs(df, 20_000).agg(F.max("source")).first()[0] == 19_999


def test_type_map_of_very_many_types(spark):
    df = spark.range(60_000).select(F.lit("success").alias("status"),
                                    F.when(F.col("id") < 500, "memo").otherwise(F.concat(F.lit("free text "), F.col("id").cast("string"))).alias("document_type"))
    got = R.report_types(df, most=3).first().document_types
    assert got == {"memo": 500, "free text 500": 1, "free text 501": 1, "(other types)": 59_498} or (
        got.pop("memo") == 500 and got.pop("(other types)") == 59_498 and len(got) == 2)
    few = R.report_types(df.where("document_type = 'memo'"), most=3).first().document_types
    assert few == {"memo": 500} and R.report_types(df.limit(0)).first().document_types == {}


def test_latest_answer_and_carried_columns(spark):
    answers = spark.createDataFrame([("k", "b", 1, "x"), ("k", "a", 2, "y"), ("k", "c", 0, "z"), ("q", None, 5, "w")],
                                    "request_key string, response_text string, at int, expected string")
    req = spark.createDataFrame([("k",), ("q",), ("none",)], "request_key string")
    first = {r.request_key: (r.response_text, r.call_stage) for r in recorded_scorer(answers)(req).collect()}
    assert first == {"k": ("a", "ok"), "q": (None, "missing"), "none": (None, "missing")}
    late = recorded_scorer(answers, latest_col="at", carry=["expected"])(req)
    assert {r.request_key: (r.response_text, r.expected) for r in late.collect()} == {"k": ("a", "y"), "q": (None, "w"), "none": (None, None)}
    last = recorded_scorer(answers.withColumn("at", -F.col("at")), latest_col="at")(req)
    assert {r.response_text for r in last.collect()} == {"c", None}
