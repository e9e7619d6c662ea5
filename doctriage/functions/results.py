"""Result records: to JSON, from JSON, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_THRESHOLD, DOCUMENT_TYPES
from .confidence import confidence_level, is_confident, score_error


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def utc_wall(ts) -> Column:
    """The UTC wall-clock time of an instant, whatever the session time zone (UTC everywhere)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(ts).cast("timestamp").cast("timestamp_ntz"))


def iso_timestamp(ts) -> Column:
    """ISO-8601 text in UTC with ``+00:00``; the fraction only when it is non-zero."""
    t = _c(ts)
    w = utc_wall(t)
    frac = F.date_format(w, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    whole = F.date_format(w, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return F.when(F.unix_micros(t.cast("timestamp")) % 1000000 != 0, frac).otherwise(whole)


def result_error(document_id="document_id") -> Column:
    """Result validation: the id must be non-empty."""
    i = _c(document_id)
    return F.when(i.isNull() | (i == ""), F.lit("Document ID is required"))


def result_record(document_id="document_id", predicted_type="predicted_type", primary_score="primary_score",
                  secondary_scores="secondary_scores", threshold="threshold", reasoning="reasoning",
                  extracted_features="extracted_features", processing_time_ms="processing_time_ms",
                  model_used="model_used", timestamp="timestamp") -> Column:
    """The result as a nested record with derived confidence fields."""
    return F.struct(
        _c(document_id).alias("document_id"),
        _c(predicted_type).alias("predicted_type"),
        F.struct(
            _c(primary_score).alias("primary_score"),
            _c(secondary_scores).alias("secondary_scores"),
            _c(threshold).alias("threshold"),
            is_confident(primary_score, threshold).alias("is_confident"),
            confidence_level(primary_score).alias("confidence_level"),
        ).alias("confidence"),
        _c(reasoning).alias("reasoning"),
        F.try_parse_json(F.coalesce(_c(extracted_features), F.lit("{}"))).alias("extracted_features"),
        _c(processing_time_ms).alias("processing_time_ms"),
        _c(model_used).alias("model_used"),
        iso_timestamp(timestamp).alias("timestamp"),
    )


def result_to_json(**cols) -> Column:
    """JSON text of :func:`result_record`, nulls written out."""
    return F.to_json(result_record(**cols), {"ignoreNullFields": "false"})


RECORD_SCHEMA = ("document_id string, predicted_type string, "
                 "confidence struct<primary_score double, secondary_scores map<string,double>, threshold double>, "
                 "reasoning string, extracted_features string, processing_time_ms bigint, model_used string, "
                 "timestamp string")


def result_from_json(df: DataFrame, json_col: str) -> DataFrame:
    """Result records from JSON with defaults; an invalid record gets ``record_error``.

    The type is *not* lower-cased here (unlike the answer parser); an unknown type
    is an error.  Checks run in the reference's order: scores, timestamp, type,
    then the id.  Before them, text that is no JSON object and a score that is no
    number get errors of their own.
    """
    v = F.try_parse_json(F.col(json_col))
    score_kind = F.schema_of_variant(F.try_variant_get(v, "$.confidence.primary_score", "variant"))
    no_number = score_kind.isNotNull() & ~score_kind.rlike("^(BIGINT|DECIMAL.*|DOUBLE|FLOAT|VOID)$")
    r = F.from_json(F.col(json_col), RECORD_SCHEMA)
    conf = F.coalesce(r.confidence, F.struct(F.lit(None).cast("double").alias("primary_score"),
                                             F.lit(None).cast("map<string,double>").alias("secondary_scores"),
                                             F.lit(None).cast("double").alias("threshold")))
    primary = F.coalesce(conf.primary_score, F.lit(0.0))
    secondary = F.coalesce(conf.secondary_scores, F.create_map().cast("map<string,double>"))
    threshold = F.coalesce(conf.threshold, F.lit(DEFAULT_THRESHOLD))
    raw_type = F.coalesce(r.predicted_type, F.lit("unknown"))
    ts_text = r.timestamp
    ts = F.try_to_timestamp(ts_text)
    doc_id = F.coalesce(r.document_id, F.lit(""))
    empty = r.document_id.isNull() & r.predicted_type.isNull() & r.confidence.isNull()
    no_object = empty & ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    err = (F.when(no_object, F.lit("Record is not a JSON object"))
           .when(no_number, F.lit("Primary score is not a number"))
           .when(score_error(primary, secondary).isNotNull(), score_error(primary, secondary))
           .when(ts_text.isNotNull() & ts.isNull(),
                 F.concat(F.lit("Invalid isoformat string: '"), ts_text, F.lit("'")))
           .when(~raw_type.isin(DOCUMENT_TYPES),
                 F.concat(F.lit("'"), raw_type, F.lit("' is not a valid DocumentType")))
           .when(doc_id == "", F.lit("Document ID is required")))
    return df.withColumns({
        "document_id": doc_id,
        "predicted_type": F.when(raw_type.isin(DOCUMENT_TYPES), raw_type),
        "confidence": F.struct(primary.alias("primary_score"), secondary.alias("secondary_scores"),
                               threshold.alias("threshold")),
        "reasoning": r.reasoning,
        "extracted_features": F.coalesce(r.extracted_features, F.lit("{}")),
        "processing_time_ms": r.processing_time_ms,
        "model_used": r.model_used,
        "timestamp": F.coalesce(ts, F.current_timestamp()),
        "record_error": err,
    })
