"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from growthkit.llm.byte_bpe import token_report
from growthkit.llm.language import languages
from growthkit.llm.near_text import near_duplicates
from growthkit.llm.near_vectors import near_vectors
from growthkit.llm.neighbours import neighbour_quality
from growthkit.llm.packing import packed
from growthkit.llm.page_text import main_text
from growthkit.llm.quality import oracle, quality_report
from growthkit.llm.repeats import repeated_bytes
from growthkit.llm.secret_scan import secrets
from growthkit.llm.token_links import token_links
from growthkit.llm.toxicity import toxicity
from growthkit.llm.turns import repaired

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return secrets(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op3_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_hierarchical_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op5_threshold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"), shared=True)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_report(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_pivot_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op11_merge_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_level, pieces = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_links(table(spark, sf_dir, "documents"), byte_level, pieces)


def op12_wagner_fischer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_token_efficiency": op1_token_efficiency,
    "op2_host_suffix_array": op2_host_suffix_array,
    "op3_positive_unlabelled": op3_positive_unlabelled,
    "op4_hierarchical_svm": op4_hierarchical_svm,
    "op5_threshold_table": op5_threshold_table,
    "op6_suffix_array": op6_suffix_array,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_sum_of_squares": op8_sum_of_squares,
    "op9_superminhash": op9_superminhash,
    "op10_pivot_range_join": op10_pivot_range_join,
    "op11_merge_path": op11_merge_path,
    "op12_wagner_fischer": op12_wagner_fischer,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLES: dict[str, str] = {"op5_threshold_table": oracle()}
