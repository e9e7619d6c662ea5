"""Answer text to typed classification columns (D9, D10, D11 on the primary score).

Only :func:`~doctriage.functions.answer_json.extract_answer` runs in Python; type
normalisation, range validation, fallbacks and reason texts are native columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answer_json import extract_answer
from ..session import ship_package
from ..functions.confidence import score_in_range
from ..schemas import (DEFAULT_THRESHOLD, DOCUMENT_TYPES, REASON_API, REASON_BATCH, REASON_PARSE,
                       SCORE_RANGE_MESSAGE)

PARSED_COLUMNS = ["predicted_type", "primary_score", "threshold", "reasoning",
                  "extracted_features", "stage", "error"]


def normalize_type(raw) -> Column:
    """Lower-cased type when it is one of the 25 accepted types, else ``unknown``."""
    low = F.lower(raw)
    return F.when(low.isin(DOCUMENT_TYPES), low).otherwise(F.lit("unknown"))


def fallback_reason(stage, error) -> Column:
    """Reason text of a fallback row by stage."""
    return (F.when(stage == "parse", F.concat(F.lit(REASON_PARSE), error))
            .when(stage == "api", F.concat(F.lit(REASON_API), error))
            .when(stage.isin("batch", "missing", "timeout"), F.concat(F.lit(REASON_BATCH), error)))


def parse_response(df: DataFrame, response_col: str = "response_text",
                   threshold: float = DEFAULT_THRESHOLD, stage_col: str | None = None,
                   error_col: str | None = None) -> DataFrame:
    """Add the parsed classification columns for each answer.

    ``stage_col``/``error_col`` optionally carry the scorer's own outcome
    (``api``/``batch``/``missing``/``timeout`` with a message); those rows are not
    parsed.  Resulting ``stage``: ok, parse, api, batch, missing, timeout.
    """
    ship_package(df.sparkSession)  # the parser runs in Python workers
    ans = "__answer"
    out = df.withColumn(ans, extract_answer(F.col(response_col)))
    a = F.col(ans)
    # float() never yields None, so a NULL score on an ``ok`` answer is a NaN that
    # Arrow turned into a null: out of range like any other NaN.
    range_bad = (a.kind == "ok") & ~F.coalesce(score_in_range(a.score), F.lit(False))
    parsed_stage = F.when(range_bad, F.lit("parse")).otherwise(a.kind)
    parsed_error = F.when(range_bad, F.lit(SCORE_RANGE_MESSAGE)).otherwise(a.error)
    if stage_col is not None:
        pre = F.col(stage_col)
        stage = F.when(pre.isNotNull() & (pre != "ok"), pre).otherwise(parsed_stage)
        error = F.when(pre.isNotNull() & (pre != "ok"), F.col(error_col)).otherwise(parsed_error)
    else:
        stage, error = parsed_stage, parsed_error
    out = out.withColumn("stage", stage).withColumn("error", error)
    ok = F.col("stage") == "ok"
    out = out.withColumns({
        "predicted_type": F.when(ok, normalize_type(a.predicted_type)).otherwise(F.lit("unknown")),
        "primary_score": F.when(ok, a.score).otherwise(F.lit(0.0)),
        "threshold": F.when(ok, F.lit(float(threshold))).otherwise(F.lit(DEFAULT_THRESHOLD)),
        "reasoning": F.when(ok, a.reasoning).otherwise(fallback_reason(F.col("stage"), F.col("error"))),
        "extracted_features": F.when(ok, a.extracted_features).otherwise(F.lit("{}")),
    })
    return out.drop(ans)


def answer_status(stage) -> Column:
    """Per-document run status: a parse or API fallback still returned a result."""
    s = F.col(stage) if isinstance(stage, str) else stage
    return (F.when(s.isin("ok", "parse", "api"), F.lit("success"))
            .when(s == "timeout", F.lit("timeout"))
            .otherwise(F.lit("error")))
