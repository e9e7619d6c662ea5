"""Result records (D19-D22): the reference's to/from-record facts as DataFrame tests."""

import json

from pyspark.sql import functions as F

from doctriage.functions.results import iso_timestamp, result_error, result_from_json, result_to_json


def test_result_to_json_with_derived_confidence(spark):
    df = spark.createDataFrame(
        [("test-doc-1", "invoice", 0.9, {"contract": 0.1}, 0.8, "Test reasoning", '{"key": "value"}', 1500,
          "test-model")],
        "document_id string, predicted_type string, primary_score double, secondary_scores map<string,double>, "
        "threshold double, reasoning string, extracted_features string, processing_time_ms bigint, model_used string")
    df = df.withColumn("timestamp", F.to_timestamp(F.lit("2023-01-01T12:00:00Z")))
    rec = json.loads(df.select(result_to_json()).first()[0])
    assert rec["confidence"] == {"primary_score": 0.9, "secondary_scores": {"contract": 0.1}, "threshold": 0.8,
                                 "is_confident": True, "confidence_level": "Very High"}
    assert rec["timestamp"] == "2023-01-01T12:00:00+00:00"
    assert rec["extracted_features"] == {"key": "value"} and rec["processing_time_ms"] == 1500


def test_iso_fraction_only_when_nonzero(spark):
    df = spark.createDataFrame([("2023-01-01T12:00:00.250000Z",), ("2023-01-01T12:00:00Z",)], "t string")
    out = [r[0] for r in df.select(iso_timestamp(F.to_timestamp("t"))).collect()]
    assert out == ["2023-01-01T12:00:00.250000+00:00", "2023-01-01T12:00:00+00:00"]


def test_result_from_json_defaults_and_errors(spark):
    recs = [
        {"document_id": "a", "predicted_type": "invoice", "timestamp": "2023-01-01T12:00:00Z"},
        {"document_id": "b", "predicted_type": "INVOICE"},                       # not lower-cased here
        {"document_id": "", "predicted_type": "memo"},
        {"document_id": "c", "confidence": {"primary_score": 1.5}},
        {"document_id": "d", "timestamp": "not a time"},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in recs], "j string")
    out = result_from_json(df, "j").collect()
    assert out[0].record_error is None and out[0].confidence.threshold == 0.7
    assert out[0].confidence.primary_score == 0.0
    assert out[1].record_error == "'INVOICE' is not a valid DocumentType"
    assert out[2].record_error == "Document ID is required"
    assert out[3].record_error == "Primary score must be between 0.0 and 1.0"
    assert out[4].record_error == "Invalid isoformat string: 'not a time'"


def test_result_validation(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "document_id string")
    assert [r[0] for r in df.select(result_error()).collect()] == [None, "Document ID is required",
                                                                   "Document ID is required"]
