"""Exact dedup (operator 1): 128-bit content hash, then the bytes inside each hash group.

Texts are equal when they are identical after the deletion of white space.  Copies are
aggregated on (hash, bytes) with map-side combine, so a group that holds a third of all rows
reaches the shuffle as one row a task, and two texts that share a hash never share a class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import NO_ID, SPACE, column, kept_rows, own_rows

_TWO64 = str(2**64)


def content_hash(norm: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(norm))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id.  A null
    text counts as empty; a null id counts as larger than all others, and as one id.  Rows
    repeated with the same id and text count in ``group_size`` and share their verdict.  An
    empty table gives an empty result.  ``hash_of`` replaces the content hash (tests use weak
    ones: the classes are the same).
    """
    return _judged(docs, doc_id, text, hash_of).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _judged(docs: DataFrame, doc_id: str, text: str, hash_of: Callable[[Column], Column], *more: str) -> DataFrame:
    """``exact_duplicates`` with ``_length`` in code points and the columns ``more`` of ``docs``."""
    raw = F.coalesce(column(docs, text).cast("string"), F.lit(""))
    rows = docs.select(column(docs, doc_id).cast("long").alias("doc_id"), raw.alias("_raw"), *more)
    rows = rows.withColumn("_norm", F.regexp_replace("_raw", SPACE + "+", ""))
    # the row to keep as one number, so that the aggregation can combine it in place:
    # code points first, then the smaller id
    rank = (F.length("_raw").cast("decimal(20,0)") * F.lit(_TWO64).cast("decimal(20,0)")
            + (F.lit(NO_ID).cast("decimal(20,0)") - F.coalesce("doc_id", F.lit(NO_ID)).cast("decimal(20,0)"))
            ).cast("decimal(38,0)")
    classes = (rows.select(hash_of(F.col("_norm")).alias("_h"), "_norm", rank.alias("_rank"))
               .groupBy("_h", "_norm").agg(F.max("_rank").alias("_rank"), F.count("*").alias("group_size")))
    keep = (F.lit(NO_ID).cast("decimal(20,0)")
            - F.pmod(F.col("_rank"), F.lit(_TWO64).cast("decimal(38,0)"))).cast("long")
    # a class is told apart from others of its hash group by a second digest, checked here
    labels = (classes.select("_h", F.sha2("_norm", 256).alias("_sha"), keep.alias("_keep"), "group_size")
              .groupBy("_h", "_sha")
              .agg(F.max("_keep").alias("_keep"), F.max("group_size").alias("group_size"), F.count("*").alias("_n"))
              .withColumn("_keep", F.when(F.col("_n") == 1, F.col("_keep"))
                          .otherwise(F.raise_error(F.lit("two texts share both digests")).cast("long"))))
    labels = materialize(labels, "labels")  # so that the join can split a class that holds a third of all rows
    keyed = rows.select("doc_id", hash_of(F.col("_norm")).alias("_h"), F.sha2("_norm", 256).alias("_sha"),
                        F.length("_raw").alias("_length"), *more)
    joined = keyed.join(labels, ["_h", "_sha"])
    keep_id = F.nullif(F.col("_keep"), F.lit(NO_ID))
    return joined.select("doc_id", keep_id.alias("keep_id"), "group_size",
                         F.col("doc_id").eqNullSafe(keep_id).alias("kept"), F.col("_sha").alias("text_sha256"), "_length", *more)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each class of equal texts.

    Of rows that repeat the id of the row to keep, or that have no id, the first with the most
    code points stays.
    """
    stored = own_rows(docs)
    name = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    found = _judged(stored, name[doc_id], name[text], content_hash, "_row").filter("kept")
    # most code points, then the first row, as one number
    rank = ((F.lit(2**31) - F.col("_length")).cast("decimal(20,0)") * F.lit(_TWO64).cast("decimal(20,0)")
            + F.col("_row").cast("decimal(20,0)")).cast("decimal(38,0)")
    first = found.withColumn("_rank", rank).groupBy("text_sha256").agg(F.min("_rank").alias("_rank"))
    kept = first.select(F.pmod(F.col("_rank"), F.lit(_TWO64).cast("decimal(38,0)")).cast("long").alias("_row"))
    return kept_rows(stored, kept, docs)


ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm,
         length(coalesce(text, '')) AS cp FROM documents),
k AS (
  SELECT norm, count(*) AS group_size, first(doc_id ORDER BY cp DESC, doc_id) AS keep_id FROM n GROUP BY norm)
SELECT n.doc_id, k.keep_id, k.group_size, n.doc_id = k.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN k ON n.norm = k.norm
"""
