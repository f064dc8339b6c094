"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymend.llm import (
    cap_filters,
    chat,
    decontamination,
    fill_in_middle,
    language_id,
    mixing,
    packing,
    quality,
    set_join,
    suffix_dedup,
    token_counts,
    toxicity,
    vector_codes,
)
from daymend.llm.frames import read


def op1_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(read(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("text")


def op7_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select(*own.columns)
    return chat.digests(chat.examples(turns.union(own)))


def op8_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_count_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.set_join(read(spark, sf_dir, "documents"))


def op11_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(read(spark, sf_dir, "documents"), mixing.quality_weights(read(spark, sf_dir, "labels")))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(read(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_cap_filters, op2_string_tiling, op3_kneser_ney_quality, op4_suffix_array_dedup, op5_best_fit_packing, op6_toxicity, op7_prefix_targets,
        op8_hyperdimensional_language, op9_token_counts, op10_count_vector_join, op11_mixture, op12_vector_codes, op13_fill_in_middle)}
ORACLES: dict[str, str] = {
    "op11_mixture": mixing.ORACLE, "op12_vector_codes": vector_codes.ORACLE, "op13_fill_in_middle": fill_in_middle.ORACLE}
