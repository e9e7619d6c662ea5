"""Connected components of an edge table, by large-star / small-star rounds.

Each round is two aggregations and joins on a node; their results are written to the shared
folder, so lineage stays short and lost executors cost one round.  Only two numbers a round
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # stored: with an aggregate between a join and its shuffles, a hot node's edges could not be split
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    rest = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge to another; the root is the smallest node it reaches.

    ``edges`` has columns u, v (long); loops and repeated edges do not matter.
    """
    now = materialize(edges.filter("u != v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = materialize(_small_star(materialize(_large_star(now), "large-star")).distinct(), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
