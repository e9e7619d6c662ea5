"""Mixing sources to target weights (operator 2): weighted fair queueing, DataFrame functions only.

Each source's documents are shuffled (by a hash of the id) and queued, copy after copy.  A
document's virtual finish time is its source's cumulative tokens divided by the source's
target.  Merged by that time, the queues would be cut where the budget is used up, at virtual
time 1, and the documents in progress there give the words before the cut.  All sources reach
time 1 together, so the cut has a closed form, and no merge is made to find it: of each source
the first floor(target) words of its own queue.  The sort of ``mix`` orders its result only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import WORD, column, numbered, own_rows

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def _shuffle_key(doc_id: Column, text: Column) -> Column:
    """A hash of the id; rows without one are spread by their texts, so they share no block."""
    own = F.concat(F.lit("null:"), F.coalesce(F.md5(text), F.lit("")))
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), own)))


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", *more: str) -> DataFrame:
    """doc_id, source, size (words) and the shuffle key of each row, and the columns ``more``."""
    size = F.coalesce(F.regexp_count(column(docs, text).cast("string"), F.lit(WORD)), F.lit(0))
    key = _shuffle_key(column(docs, doc_id).cast("long"), column(docs, text).cast("string"))
    return docs.select(column(docs, doc_id).cast("long").alias("doc_id"), column(docs, source).cast("string").alias("source"),
                       size.cast("long").alias("size"), key.alias("_key"), *more)


def source_targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target: ``share`` of all sizes dealt by weight, at most ``most`` times a source.

    Weights go round the sources in code point order, null last.  Sources that reach their
    limit are set aside and the rest is dealt again, until none is above: each round is an
    aggregation over the sources that returns three numbers.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = materialize(ranked.withColumn("_weight", weight.cast("double"))
                          .withColumn("_limit", F.col("source_size") * F.lit(float(most))), "sources")
    first = sources.agg(F.sum("source_size").alias("s"), F.sum("_weight").alias("w")).first()
    budget = share * (first["s"] or 0)
    level, capped = (budget / first["w"] if first["w"] else 0.0), -1
    while True:
        full = F.col("_limit") <= F.col("_weight") * F.lit(level)
        r = sources.agg(F.sum(F.when(full, F.col("_limit"))).alias("limits"),
                        F.sum(F.when(~full, F.col("_weight"))).alias("w"),
                        F.count(F.when(full, F.lit(1))).alias("n")).first()
        if r["n"] == capped or not r["w"]:
            break
        level, capped = (budget - (r["limits"] or 0.0)) / r["w"], r["n"]
    target = F.least(F.col("_limit"), F.col("_weight") * F.lit(level))
    return sources.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per input row, in mix order: doc_id, size, source_size, target, taken, finish_time.

    ``taken`` is the number of words that the mix takes of the document, all copies together
    (``most`` times its size at most); ``finish_time`` is the virtual finish time of its first
    copy.  A null text has size 0, a null source is a source of its own (last), a source
    without words has target 0 and finish time 0.  Rows with the same id are queued by size.
    Reruns agree: the shuffle is a hash of the id, or of the text of a row without one.

    The running sum within a source goes by 4096 blocks of the shuffle key: a source that
    holds a third of all rows is summed by as many tasks, never by one.
    """
    return (_queued(docs, doc_id, text, source, weights, share, most)
            .orderBy("finish_time", "_key", "doc_id").drop("_key"))


def _queued(docs: DataFrame, doc_id: str, text: str, source: str, weights, share: float, most: int,
            *more: str) -> DataFrame:
    """``mix`` in no order, with the shuffle key and the columns ``more`` of ``docs``, by which ties are queued."""
    rows = materialize(sized(docs, doc_id, text, source, *more), "sized")
    targets = source_targets(rows, weights, share, most)
    # null sources join and group like any other under a key that is never null
    rows = rows.withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
    targets = targets.withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))).drop("source")
    rows = rows.withColumn("_block", F.substring("_key", 1, 3)).drop("source")
    blocks = rows.groupBy("_source", "_block").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (blocks.withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
             .join(targets, "_source").drop("_sum"))
    within = (Window.partitionBy("_source", "_block").orderBy("_key", "doc_id", "size", *more)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queued = rows.withColumn("_upto", F.sum("size").over(within)).join(bases, ["_source", "_block"])
    before = F.col("_base") + F.col("_upto") - F.col("size")
    quota = F.floor("target")
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), quota - before - copy * F.col("source_size")))
                 for copy in range(1, most)), F.greatest(F.lit(0), F.least(F.col("size"), quota - before)))
    finish = F.when(F.col("target") > 0, (before + F.col("size")) / F.col("target")).otherwise(F.lit(0.0))
    return queued.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"),
                         finish.alias("finish_time"), "_key", *more)


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix as documents with the columns of ``docs``: a row for each copy that is taken.

    A copy that the budget cuts holds its first words, joined by spaces.  Rows that repeat an id,
    or have none, are rows of their own, each with its own copies.
    """
    inner = own_rows(docs)
    renamed = [c for c in inner.columns if c != "_row"]
    body, key, origin = (renamed[docs.columns.index(c)] for c in (text, doc_id, source))
    plan = _queued(inner, key, body, origin, weights, share, most, "_row")
    plan = plan.filter("taken > 0").select("_row", "size", "taken")
    copies = plan.select("_row", F.explode(F.sequence(F.lit(0), F.expr("(taken - 1) div size"))).alias("_copy"),
                         "size", "taken")
    copies = copies.select("_row", F.least(F.col("size"), F.col("taken") - F.col("_copy") * F.col("size")).alias("_take"),
                           F.col("size").alias("_size"))
    joined = inner.join(copies, "_row")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col(body), F.lit(WORD), F.lit(0)), F.lit(1),
                               F.col("_take").cast("int")), " ")
    joined = joined.withColumn(body, F.when(F.col("_take") < F.col("_size"), cut).otherwise(F.col(body)))
    return joined.select(*renamed).toDF(*docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix:' || CAST(doc_id AS VARCHAR)) AS k FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE
              ELSE 2.0::DOUBLE END AS w FROM d GROUP BY source),
o AS (
  SELECT *, CAST(1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER q, 0) AS DOUBLE) AS rest,
         sum(w) OVER (ORDER BY source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wrest,
         row_number() OVER (ORDER BY source_size / w, source) AS place
  FROM s WINDOW q AS (ORDER BY source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT arg_min(rest / wrest, place) FILTER (WHERE 2 * source_size * wrest > w * rest) AS level FROM o),
t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, w * coalesce((SELECT level FROM lev), 1e300)) AS target
  FROM s),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS quota,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS b
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(size, quota - b)) + greatest(0, least(size, quota - b - source_size)) AS BIGINT) AS taken,
       CASE WHEN target > 0 THEN CAST(b + size AS DOUBLE) / target ELSE 0.0::DOUBLE END AS finish_time
FROM c
"""
