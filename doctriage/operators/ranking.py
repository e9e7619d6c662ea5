"""Positions in a global order, and skip/take by them.

A range sort spreads the rows; the rows before each partition are the prefix sum of the
partitions' counts, a table of one row a partition.  So a take of half the table is a filter
on positions, and no task holds more than its range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize


def with_position(df: DataFrame, order: str | list[str], name: str = "position") -> DataFrame:
    """``df`` with the gapless position, from 0, of each row in ``order`` (equal rows in any order).

    The sorted rows are stored: a lost executor cannot number them anew.
    """
    by = [order] if isinstance(order, str) else list(order)
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    stored = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__at", 33)
    counts = stored.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    bases = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    placed = stored.withColumn("__part", part).join(F.broadcast(bases), "__part")
    within = F.col("__at") - F.shiftleft(F.col("__part"), 33)
    return placed.withColumn(name, F.col("__base") + within).drop("__at", "__part", "__base")


def take(df: DataFrame, skip: int, n: int | None, order: str | list[str]) -> DataFrame:
    """Rows ``skip`` to ``skip + n`` of ``order`` (to the end where ``n`` is None), in no order."""
    name = "__position"
    rows = with_position(df, order, name).where(F.col(name) >= skip)
    return (rows if n is None else rows.where(F.col(name) < skip + n)).drop(name)
