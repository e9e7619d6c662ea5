"""Confidence semantics as native Column expressions.

Spark orders NaN above every number (``NaN >= 0.9`` is true) while the
reference compares IEEE-style (NaN compares false).  Every comparison here
guards NaN explicitly so both agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (ACCEPT_SCORE, CONFIDENCE_LEVELS, DEFAULT_THRESHOLD, HIGH_CONFIDENCE,
                       LOWEST_LEVEL, SCORE_RANGE_MESSAGE)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _ge(score: Column, bound) -> Column:
    """``score >= bound`` with NaN comparing false (NULL stays NULL)."""
    bound = bound if isinstance(bound, Column) else F.lit(bound)
    return (score >= bound) & ~F.isnan(score) & ~F.isnan(bound)


def score_in_range(score) -> Column:
    """True when 0 <= score <= 1; false for NaN and infinities."""
    s = _c(score)
    return s.between(0.0, 1.0) & ~F.isnan(s)


def score_error(primary, secondary=None) -> Column:
    """Validation message of a confidence value, NULL when valid.

    The primary score is checked first, then the secondary scores in map order.
    """
    p = _c(primary)
    msg = F.when(~score_in_range(p), F.lit(SCORE_RANGE_MESSAGE))
    if secondary is not None:
        bad = F.map_filter(_c(secondary), lambda k, v: ~(v.between(0.0, 1.0) & ~F.isnan(v)))
        first_bad = F.element_at(F.map_keys(bad), 1)
        msg = msg.when(F.size(bad) > 0,
                       F.concat(F.lit("Score for "), first_bad, F.lit(" must be between 0.0 and 1.0")))
    return msg


def confidence_level(score) -> Column:
    """Five-level label."""
    s = _c(score)
    expr = None
    for bound, label in CONFIDENCE_LEVELS:
        cond = _ge(s, bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(s.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(LOWEST_LEVEL)))


def is_confident(score, threshold=None) -> Column:
    """Score meets the threshold."""
    t = F.lit(DEFAULT_THRESHOLD) if threshold is None else _c(threshold)
    return _ge(_c(score), t)


def is_high_confidence(score) -> Column:
    """Score >= 0.8 whatever the threshold."""
    return _ge(_c(score), HIGH_CONFIDENCE)


def needs_review(score, threshold=None) -> Column:
    """Not confident."""
    return ~is_confident(score, threshold)


def status_label(score, threshold=None) -> Column:
    """CLI status indicator: high first, then review, then standard."""
    return (F.when(is_high_confidence(score), F.lit("High confidence result!"))
            .when(needs_review(score, threshold), F.lit("Needs human review"))
            .otherwise(F.lit("Standard confidence result")))


def accept_code(score, failed=None) -> Column:
    """0 when score >= 0.7 (fixed bound), 1 below, 2 when the row failed."""
    code = F.when(_ge(_c(score), ACCEPT_SCORE), F.lit(0)).otherwise(F.lit(1))
    if failed is not None:
        code = F.when(_c(failed), F.lit(2)).otherwise(code)
    return code
