"""Registry of queries (Spark) and their DuckDB oracle SQL, with shared oracle pieces.

The queries live in the ``*_queries`` modules of this package, grouped by topic;
they register themselves here on import.

Every query reads the driver tables (or data Spark derives from them) in full.
Oracles compute the expected answer from the fixture's construction rule, not by
re-running the operator's logic in SQL.  Floating results are rounded to 6
places on both sides so summation order cannot change the hash.  Queries that
exercise file sources/sinks write their derived input under the session's
checkpoint folder first, then read it back through the operator.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.score import classify, recorded_scorer
from ..session import ship_package
from . import fixtures as fx

MODEL_ID = "us.amazon.nova-lite-v1:0"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; running it first ships the package to the executors."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def classified(spark: SparkSession, d: str) -> DataFrame:
    """requests_fx classified with the recorded answers of answers_fx."""
    return classify(fx.requests_fx(spark, d), fx.recorded(spark, d), model=MODEL_ID)


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(cols)}))"


EXPECTED = f"({fx.expected_sql()})"
REQ = f"({fx.requests_sql()})"
RES = f"({fx.results_sql()})"
ALIASES = _values(S.MODEL_ALIASES, ["model", "alias"])
CATALOG = _values(S.MODEL_CATALOG, ["alias", "model_id", "name", "cost", "speed"])
PRICES = _values(S.MODEL_PRICES, ["model", "price_per_1k"])
TYPES = _values(S.DOCUMENT_TYPE_FAMILIES, ["document_type", "family"])

PROMPT_FRAME_SQL = (S.PROMPT_HEAD + ", ".join(S.OFFERED_TYPES) + S.PROMPT_MIDDLE).replace("'", "''")
PROMPT_TAIL_SQL = S.PROMPT_TAIL.replace("'", "''")

PROMPT_MD5_SQL = f"md5('{PROMPT_FRAME_SQL}' || document_content || '{PROMPT_TAIL_SQL}')"

LEVEL_SQL = ("CASE WHEN {s} >= 0.9 THEN 'Very High' WHEN {s} >= 0.8 THEN 'High' WHEN {s} >= 0.7 THEN 'Medium' "
             "WHEN {s} >= 0.5 THEN 'Low' ELSE 'Very Low' END")


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


# The query modules register themselves on import.
from . import (classification_queries, io_queries, record_queries, report_queries,  # noqa: E402,F401
               streaming_queries, text_queries)
