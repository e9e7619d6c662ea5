"""Registered queries of this subpackage: one ``opN_<name>`` per operator, with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from . import (backoff, exact_dedup, language, mixing, packing, phrases, repetition, sharding, simhash, suffix_dedup, token_files,
               toxicity, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
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


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_register("op1_exact_dedup", exact_dedup.ORACLE)
def op1(spark, d):
    return exact_dedup.exact_duplicates(documents(spark, d))


@_register("op2_source_mix", mixing.ORACLE)
def op2(spark, d):
    return mixing.mix(documents(spark, d))


@_register("op3_toxicity")
def op3(spark, d):
    docs = documents(spark, d)
    return toxicity.severity(docs, toxicity.fit(docs, spark.read.parquet(f"{d}/labels.parquet")))


@_register("op4_token_files")
def op4(spark, d):
    return token_files.read_token_files(spark, token_files.write_token_files(documents(spark, d)))


@_register("op5_repetition_rules")
def op5(spark, d):
    return repetition.quality(documents(spark, d))


@_register("op6_language_id")
def op6(spark, d):
    docs = documents(spark, d)
    return language.identify(docs, language.fit(docs)).drop("langs")


@_register("op7_packing")
def op7(spark, d):
    return packing.pack_documents(documents(spark, d))


@_register("op8_rendezvous_shards", sharding.ORACLE)
def op8(spark, d):
    return sharding.shard_rows(documents(spark, d))


@_register("op9_simhash_near_dedup")
def op9(spark, d):
    return simhash.near_duplicates(documents(spark, d))


@_register("op10_suffix_array_dedup")
def op10(spark, d):
    return suffix_dedup.remove_repeats(documents(spark, d))


@_register("op11_phrase_collocations", phrases.ORACLE)
def op11(spark, d):
    return phrases.collocations(documents(spark, d))


@_register("op12_embedding_whitening")
def op12(spark, d):
    return whitening.whiten(spark.read.parquet(f"{d}/embeddings.parquet"))


@_register("op13_lm_scoring")
def op13(spark, d):
    return backoff.score(documents(spark, d))
