"""A training corpus from ``documents``: identify, dedup, dedup near copies, mix, pack.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir), and its
result, written as Parquet and read again, is the next one's docs.  All but the last return
the columns of ``documents``.  There is no SQL for the whole (language model, tokenizer,
fingerprint components); tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from doctriage.llm import exact_dedup, language, mixing, packing, simhash
from doctriage.session import materialize, ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents for which no language is found go; a mixture of languages stays."""
    ship_package(spark)
    return language.keep_identified(docs, language.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each class of equal texts stays."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the document with the smallest id of each component stays."""
    ship_package(spark)
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: a row for each copy that the mix takes; the copy that the budget cuts is cut."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the pieces of all documents with their places in sequences."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mix", source_mix),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
