"""Model and type look-ups against fixed dimensions.

The dimensions are defined in :mod:`doctriage.schemas` and have a fixed row
count (8 aliases, 17 models, 3 prices, 25 types), so broadcasting them is safe
at any data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import document_types, model_aliases, model_catalog, model_prices


def with_model_alias(df: DataFrame, model: str = "model", out: str = "model_alias") -> DataFrame:
    """Short batch name to catalogue alias; unknown names pass through."""
    al = F.broadcast(model_aliases(df.sparkSession).withColumnRenamed("model", "__m"))
    j = df.join(al, F.col(model) == F.col("__m"), "left")
    return j.withColumn(out, F.coalesce(F.col("alias"), F.col(model))).drop("__m", "alias")


def with_model_id(df: DataFrame, alias: str = "model_alias", out: str = "model_id") -> DataFrame:
    """Catalogue alias to model id; anything else is taken as an id already."""
    cat = F.broadcast(model_catalog(df.sparkSession).select(
        F.col("alias").alias("__a"), F.col("model_id").alias("__id")))
    j = df.join(cat, F.col(alias) == F.col("__a"), "left")
    return j.withColumn(out, F.coalesce(F.col("__id"), F.col(alias))).drop("__a", "__id")


def with_model_attributes(df: DataFrame, alias: str = "model_alias") -> DataFrame:
    """Catalogue name, cost and speed onto rows; NULL for models outside it."""
    cat = F.broadcast(model_catalog(df.sparkSession).select(
        F.col("alias").alias("__a"), F.col("name").alias("model_name"),
        F.col("cost").alias("model_cost"), F.col("speed").alias("model_speed")))
    return df.join(cat, F.col(alias) == F.col("__a"), "left").drop("__a")


def with_price(df: DataFrame, model: str = "model") -> DataFrame:
    """Price per 1K tokens onto rows, NULL when unpriced."""
    pr = F.broadcast(model_prices(df.sparkSession).withColumnRenamed("model", "__m"))
    return df.join(pr, F.col(model) == F.col("__m"), "left").drop("__m")


def with_type_family(df: DataFrame, type_col: str = "document_type") -> DataFrame:
    """Family and offered flag of each type (K9 dimension)."""
    dt = F.broadcast(document_types(df.sparkSession).select(
        F.col("document_type").alias("__t"), "family", "offered"))
    return df.join(dt, F.col(type_col) == F.col("__t"), "left").drop("__t")


def model_id_for(name: str) -> str:
    """Resolve one run option the way rows are resolved: short name -> alias -> model id.

    A driver-side look-up of a single parameter in the fixed dimensions; unknown
    names pass through unchanged (they may already be model ids).
    """
    from ..schemas import MODEL_ALIASES, MODEL_CATALOG
    alias = dict(MODEL_ALIASES).get(name, name)
    return {r[0]: r[1] for r in MODEL_CATALOG}.get(alias, alias)
