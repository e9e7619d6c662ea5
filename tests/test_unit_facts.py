"""Facts about records, scores and requests, by operator and around their boundaries."""

import itertools
import json
import math

import pytest
from pyspark.sql import functions as F

from doctriage.functions import confidence as C
from doctriage.functions.results import result_from_json, result_to_json
from doctriage.operators import requests as RQ
from doctriage.operators.catalog import model_id_for
from doctriage.operators.parse import normalize_type
from doctriage.schemas import DOCUMENT_TYPES, MODEL_ALIASES, document_types

BELOW = lambda x: math.nextafter(x, 0.0)
LEVELS = [(0.9, "Very High"), (0.8, "High"), (0.7, "Medium"), (0.5, "Low"), (0.0, "Very Low")]


def by_row(spark, column, *values):
    """What a column expression over ``v`` gives for each value (a single one, or a tuple as v, w)."""
    rows = [(i, *(v if isinstance(v, tuple) else (v, None))) for i, v in enumerate(values)]
    kind = "string" if any(isinstance(r[1], str) for r in rows) else "double"
    df = spark.createDataFrame(rows, f"i int, v {kind}, w double")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


class TestScores:
    def test_each_level_begins_at_its_limit(self, spark):
        limits = [x for x, _ in LEVELS[:-1]]
        assert by_row(spark, C.confidence_level("v"), *limits) == [n for _, n in LEVELS[:-1]]
        assert by_row(spark, C.confidence_level("v"), *map(BELOW, limits)) == [n for _, n in LEVELS[1:]]

    def test_scores_outside_the_unit_interval(self, spark):
        inside, outside = [0.0, 5e-324, 0.31, BELOW(1.0), 1.0], [-5e-324, math.nextafter(1.0, 2.0), -7.0, 12.0, math.inf]
        assert by_row(spark, C.score_error("v"), *inside) == [None] * len(inside)
        assert set(by_row(spark, C.score_error("v"), *outside)) == {"Primary score must be between 0.0 and 1.0"}

    def test_confidence_and_review_are_opposites(self, spark):
        pairs = list(itertools.product([0.0, 0.2, BELOW(0.55), 0.55, 1.0], [0.0, 0.55, 1.0]))
        sure = by_row(spark, C.is_confident("v", "w"), *pairs)
        assert sure == [s >= t for s, t in pairs]
        assert by_row(spark, C.needs_review("v", "w"), *pairs) == [not x for x in sure]

    def test_high_confidence_begins_at_its_limit(self, spark):
        got = by_row(spark, C.is_high_confidence("v"), 0.0, BELOW(0.8), 0.8, 1.0)
        assert got == [False, False, True, True]


class TestTypes:
    def test_all_types_are_distinct_and_known(self, spark):
        listed = [r.document_type for r in document_types(spark).collect()]
        assert sorted(listed) == sorted(set(DOCUMENT_TYPES)) and len(listed) == 25

    def test_answers_map_unknown_types_where_records_reject_them(self, spark):
        names = [*DOCUMENT_TYPES[:3], "zeppelin", ""]
        assert by_row(spark, normalize_type(F.col("v")), *names) == [*DOCUMENT_TYPES[:3], "unknown", "unknown"]
        lines = [json.dumps({"document_id": "n1", "predicted_type": n}) for n in names[:4]]
        errors = [r.record_error for r in result_from_json(spark.createDataFrame([(x,) for x in lines], "j string").coalesce(1), "j").collect()]
        assert errors[:3] == [None] * 3 and "zeppelin" in errors[3]

    def test_model_names(self):
        for full, alias in MODEL_ALIASES:
            assert model_id_for(alias) == model_id_for(full) or model_id_for(full) == full
        assert model_id_for("in-house-7b") == "in-house-7b"


class TestRequests:
    COLUMNS = ("document_id string, document_uri string, document_content string, document_metadata string, "
               "classification_config string, requester_id string")

    def one(self, spark, record):
        return RQ.request_from_json(spark.createDataFrame([(json.dumps(record),)], "value string")).first()

    def test_a_bare_record_gets_defaults(self, spark):
        row = self.one(spark, {"document_id": "n-41", "document_uri": "s3://archive/2019/letter 41.md"})
        assert row.asDict() == {"document_id": "n-41", "document_uri": "s3://archive/2019/letter 41.md", "document_content": None,
                                "document_metadata": "{}", "classification_config": "{}", "requester_id": None}

    def test_a_full_record_comes_back_as_it_was(self, spark):
        record = {"document_id": "n-42", "document_uri": "direct://x", "document_content": 'two\nlines, "quoted" \\ and ü',
                  "document_metadata": {"pages": [1, 2], "scan": {"dpi": 300}}, "classification_config": {"types": ["memo"]},
                  "requester_id": "archive job"}
        row = self.one(spark, record)
        back = RQ.request_to_json(spark.createDataFrame([row], self.COLUMNS)).first().request_json
        assert json.loads(back) == record

    @pytest.mark.parametrize("i,u,message", [("", "s3://a/b", "Document ID is required"), (None, "s3://a/b", "Document ID is required"),
                                             ("n", "", "Document URI is required"), ("n", None, "Document URI is required"),
                                             ("", "", "Document ID is required"), ("n", "s3://a/b", None)])
    def test_what_a_request_must_have(self, spark, i, u, message):
        df = spark.createDataFrame([(i, u)], "document_id string, document_uri string")
        assert RQ.validate_requests(df).first().request_error == message


class TestRecords:
    FULL = {"document_id": "n-7", "predicted_type": "memo", "reasoning": "short", "extracted_features": {"to": ["all"]},
            "confidence": {"primary_score": 0.625, "secondary_scores": {"letter": 0.25, "report": 0.125}, "threshold": 0.5},
            "processing_time_ms": 12, "model_used": "in-house-7b", "timestamp": "2031-11-30T23:59:58+00:00"}

    def read(self, spark, record):
        return result_from_json(spark.createDataFrame([(json.dumps(record),)], "j string"), "j").first()

    def test_missing_parts_get_defaults(self, spark):
        row = self.read(spark, {"document_id": "n-8", "predicted_type": "memo", "confidence": {"primary_score": 0.25}})
        assert (row.confidence.primary_score, row.confidence.threshold, row.confidence.secondary_scores) == (0.25, 0.7, {})
        assert (row.reasoning, row.extracted_features, row.model_used, row.processing_time_ms, row.record_error) == (None, "{}", None, None, None)
        assert row.timestamp is not None

    def test_a_record_without_an_id_is_an_error(self, spark):
        assert self.read(spark, {"predicted_type": "memo", "document_id": ""}).record_error == "Document ID is required"

    def test_a_full_record_round_trips(self, spark):
        row = self.read(spark, self.FULL)
        flat = spark.createDataFrame(
            [(row.document_id, row.predicted_type, row.confidence.primary_score, row.confidence.secondary_scores, row.confidence.threshold,
              row.reasoning, row.extracted_features, row.processing_time_ms, row.model_used)],
            "document_id string, predicted_type string, primary_score double, secondary_scores map<string,double>, threshold double, "
            "reasoning string, extracted_features string, processing_time_ms bigint, model_used string")
        text = flat.withColumn("timestamp", F.to_timestamp(F.lit("2031-11-30T23:59:58Z"))).select(result_to_json()).first()[0]
        got = json.loads(text)
        extra = {"is_confident": True, "confidence_level": "Low"}
        assert {k: got["confidence"].pop(k) for k in extra} == extra
        assert {k: got[k] for k in self.FULL} == self.FULL
