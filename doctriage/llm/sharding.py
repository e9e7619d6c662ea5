"""Sharding (operator 8): weighted rendezvous hashing of stable record keys.

Every shard draws a number for every key; the smallest of -ln(u) / weight wins.  A key's
draws do not depend on the other shards, so one more shard takes rows only into itself.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, numbered

SHARDS = 16
_DRAW = 2.0**52


def draw(key: Column, shard: int, weight: float) -> Column:
    """The shard's draw for a key: exponential with rate ``weight``; smaller is better."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(_DRAW)) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Index of the winning shard; shards of weight 0 never win, equal draws go to the smaller index."""
    if not any(w > 0 for w in weights) or any(w < 0 or math.isnan(w) for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    draws = [F.struct(draw(key, i, w).alias("d"), F.lit(i).alias("i")) for i, w in enumerate(weights) if w > 0]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["i"]


def shard_rows(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: Sequence[float] | None = None,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``slot`` numbers the rows of a shard from 0 by a hash of the id, then id and text hash;
    ``grown_shard`` is the shard under the weights ``grown`` (by default one shard more, of
    the mean weight).  Size is the UTF-8 length of the text plus 1; a null text has length 0
    and crc 0.  A null id is a key of its own; rows that repeat an id share its shard and get
    slots of their own.
    """
    weights = list(weights)
    grown = list(grown) if grown is not None else [*weights, sum(weights) / len(weights)]
    body = F.coalesce(column(docs, text).cast("string"), F.lit(""))
    rows = docs.select(column(docs, doc_id).cast("long").alias("doc_id"),
                       (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body).cast("long").alias("text_crc32"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = rows.select("*", F.lit("key").alias("law"), rendezvous(key, weights).cast("int").alias("shard"),
                       rendezvous(key, grown).cast("int").alias("grown_shard"), F.md5(key).alias("_order"))
    placed = numbered(rows, ["shard", "_order", "doc_id", "text_crc32", "size"], "_place")
    # a shard's first place: one row a shard
    first = placed.groupBy("shard").agg(F.min("_place").alias("_first"))
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("_place") - F.col("_first")).alias("slot"), "grown_shard"))


def _draw_sql(shard: int) -> str:
    return f"-ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':{shard}'), 1, 13) AS BIGINT) + 0.5) / {_DRAW})"


def _best_sql(n: int) -> str:
    draws = ", ".join(_draw_sql(i) for i in range(n))
    return f"CAST(list_position([{draws}], list_min([{draws}])) - 1 AS INTEGER)"


ORACLE = f"""
WITH table0 AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]),
                          lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
d AS (
  SELECT doc_id, coalesce(text, '') AS body, hex(encode(coalesce(text, ''))) AS hx FROM documents),
b AS (
  SELECT doc_id, body, CAST(strlen(body) + 1 AS BIGINT) AS size,
         [CAST('0x' || substr(hx, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT) FOR i IN range(strlen(body))] AS bytes FROM d),
c AS (
  SELECT doc_id, size,
         xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
             lambda x, y: xor(x >> 8, t[xor(x & 255, y) + 1]))) AS text_crc32,
         {_best_sql(SHARDS)} AS shard, {_best_sql(SHARDS + 1)} AS grown_shard FROM b, table0)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS slot, grown_shard
FROM c
"""
