"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from jobsignals.llm import (
    conversation_trie, exact_dedup, hard_negatives, quality_cnn, lattice_lm, mixing, near_dedup, pattern_packing, private, quality_rules,
    site_style, substring_dedup, token_output,
)
from jobsignals.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@query
def op3_packed_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.packed_report(table(spark, sf_dir, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_report(table(spark, sf_dir, "documents"))


@query
def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_report(table(spark, sf_dir, "documents"))


@query
def op7_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.main_text(table(spark, sf_dir, "pages"))


@query
def op8_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.private_report(table(spark, sf_dir, "documents"))


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("n_chunks")


@query
def op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_texts(table(spark, sf_dir, "documents"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie_report(table(spark, sf_dir, "conversations"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


@query
def op13_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
