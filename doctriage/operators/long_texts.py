"""Whole texts for a scorer with a bounded input (K4, K5): consecutive pieces, all scored, merged by a weighted vote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_THRESHOLD
from .score import classify, one_per_key

PIECE_MARK = "#piece-"


def piece_key(key: Column, piece: Column) -> Column:
    return F.concat(key, F.lit(PIECE_MARK), piece.cast("string"))


def cut_pieces(requests: DataFrame, limit: int, content_col: str = "document_content", key_col: str = "request_key") -> DataFrame:
    """A row for each ``limit`` characters of each text, with ``piece`` (from 0) and ``document_key``.

    ``content_col`` holds the piece and ``key_col`` a key of its own.  An empty or null text is one piece.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    last = F.greatest(F.lit(0), F.floor((F.length(content_col) - 1) / F.lit(limit)).cast("int"))
    rows = requests.withColumn("piece", F.explode(F.sequence(F.lit(0), F.coalesce(last, F.lit(0)))))
    return rows.withColumns({
        "document_key": F.col(key_col),
        content_col: F.substring(F.col(content_col), F.col("piece") * F.lit(limit) + 1, F.lit(limit)),
        key_col: piece_key(F.col(key_col), F.col("piece")),
    }).withColumn("piece_chars", F.coalesce(F.length(content_col), F.lit(0)))


def merge_pieces(scored: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row a document from its scored pieces.

    Each answered piece votes for its type with its characters (an empty text with one) times its
    score; the type with the most votes wins, the smaller name of two as strong.  ``primary_score``
    is the winner's votes over the characters of all answered pieces.  A document without an
    answered piece has the status and error of its first piece.  ``prompts_md5`` is of all
    pieces' prompts in order.  Pieces are summed by (document, type) and then by document,
    so a document of very many pieces is combined before it meets in one task.
    """
    ok = F.col("stage") == "ok"
    weight = F.greatest(F.col("piece_chars"), F.lit(1)).cast("double")
    by_type = scored.groupBy("document_key", F.when(ok, F.col("predicted_type")).alias("__type")).agg(
        F.sum(F.when(ok, weight * F.col("primary_score"))).alias("__votes"),
        F.sum(F.when(ok, weight)).alias("__chars"),
        F.count("*").alias("__pieces"), F.count_if(~ok).alias("__failed"),
        F.min(F.struct("piece", "stage", "status", "error")).alias("__first"),
        F.collect_list(F.struct("piece", "prompt_md5")).alias("__prompts"))
    voted = F.when(F.col("__type").isNotNull(), F.struct((-F.round("__votes", 6)).alias("v"), F.col("__type").alias("t")))
    merged = by_type.groupBy("document_key").agg(
        F.min(voted).alias("__best"), F.sum("__chars").alias("__chars"), F.sum("__pieces").alias("pieces"),
        F.sum("__failed").alias("failed_pieces"), F.min("__first").alias("__first"),
        F.flatten(F.collect_list("__prompts")).alias("__prompts"))
    answered = F.col("__best").isNotNull()
    return merged.select(
        F.col("document_key").alias("request_key"),
        F.when(answered, F.lit("success")).otherwise(F.col("__first.status")).alias("status"),
        F.when(answered, F.lit("ok")).otherwise(F.col("__first.stage")).alias("stage"),
        F.when(answered, F.col("__best.t")).otherwise(F.lit("unknown")).alias("predicted_type"),
        F.when(answered, -F.col("__best.v") / F.col("__chars")).otherwise(F.lit(0.0)).alias("primary_score"),
        F.lit(float(threshold)).alias("threshold"),
        F.when(~answered, F.col("__first.error")).alias("error"),
        "pieces", "failed_pieces",
        F.md5(F.array_join(F.transform(F.array_sort("__prompts"), lambda x: x["prompt_md5"]), ",")).alias("prompts_md5"))


def classify_long(requests: DataFrame, scorer: Callable[[DataFrame], DataFrame], limit: int, model: str | None = None,
                  threshold: float = DEFAULT_THRESHOLD, content_col: str = "document_content", **kwargs) -> DataFrame:
    """Classify whole texts with a scorer that takes ``limit`` characters at a time; one row for each ``request_key``.

    A key listed several times is scored once, for the text that ``one_per_key`` chooses.
    """
    one = one_per_key(requests, content_col)
    pieces = cut_pieces(one, limit, content_col)
    scored = classify(pieces, scorer, model=model, threshold=threshold, content_col=content_col, **kwargs)
    return merge_pieces(scored, threshold)
