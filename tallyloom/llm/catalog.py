"""Registered queries of the pipeline operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import (
    decontamination,
    fill_in_middle,
    language_id,
    lexical_search,
    line_dedup,
    lm_scoring,
    minhash_forest,
    mixing,
    pii,
    quality_model,
    quality_rules,
    sharding,
    simhash,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(table(spark, sf_dir, "documents"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rule_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.without_boilerplate(docs).drop("source")


@query
def op6_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


@query
def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op10_fourier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fim_digest(table(spark, sf_dir, "documents"))


@query
def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
