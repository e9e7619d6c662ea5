"""Confidence semantics: the reference's unit facts as DataFrame tests."""

import math

import pytest

from doctriage.functions import confidence as C


def _eval(spark, rows, *cols):
    df = spark.createDataFrame(rows, "s double, t double")
    return [tuple(r) for r in df.select(*cols).collect()]


@pytest.mark.parametrize("score,level", [
    (0.95, "Very High"), (0.9, "Very High"), (0.89, "High"), (0.85, "High"), (0.8, "High"),
    (0.79, "Medium"), (0.75, "Medium"), (0.7, "Medium"), (0.69, "Low"), (0.65, "Low"), (0.5, "Low"),
    (0.49, "Very Low"), (0.45, "Very Low"), (0.0, "Very Low"), (math.nan, "Very Low"),
])
def test_levels(spark, score, level):
    assert _eval(spark, [(score, 0.7)], C.confidence_level("s"))[0][0] == level


def test_confident_and_review(spark):
    rows = [(0.8, 0.7), (0.6, 0.7), (0.7, 0.7), (math.nan, 0.7)]
    out = _eval(spark, rows, C.is_confident("s", "t"), C.needs_review("s", "t"))
    assert out == [(True, False), (False, True), (True, False), (False, True)]


def test_high_confidence_ignores_threshold(spark):
    out = _eval(spark, [(0.9, 0.95), (0.7, 0.5), (0.8, 0.9)], C.is_high_confidence("s"))
    assert [r[0] for r in out] == [True, False, True]


def test_status_label_precedence(spark):
    # threshold above 0.8: a row can be both high and in review; high wins
    out = _eval(spark, [(0.85, 0.9), (0.6, 0.7), (0.75, 0.7)], C.status_label("s", "t"))
    assert [r[0] for r in out] == ["High confidence result!", "Needs human review", "Standard confidence result"]


def test_score_validation(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0.85,), (1.5,), (-0.1,), (math.nan,), (0.8,)], "s double")
    sec = F.when(F.col("s") == 0.8, F.create_map(F.lit("test"), F.lit(1.5))).otherwise(
        F.create_map().cast("map<string,double>"))
    out = [r[0] for r in df.select(C.score_error("s", sec)).collect()]
    assert out == [None, "Primary score must be between 0.0 and 1.0", "Primary score must be between 0.0 and 1.0",
                   "Primary score must be between 0.0 and 1.0", "Score for test must be between 0.0 and 1.0"]


def test_accept_code(spark):
    from pyspark.sql import functions as F
    # t > 0.6 marks a failed row here
    out = _eval(spark, [(0.7, 0.9), (0.69, 0.5), (0.7, 0.5), (0.9, 0.5)], C.accept_code("s", F.col("t") > 0.6))
    assert [r[0] for r in out] == [2, 1, 0, 0]
