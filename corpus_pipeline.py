"""A training corpus from the table documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before kept, and returns a DataFrame
that is written as Parquet and read again as the docs of the next stage. All but the last return the columns of
documents. Rows whose doc_id is null pass like others; texts may be null or empty until the quality rules.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthkit.llm.components import stored
from growthkit.llm.near_text import near_duplicates
from growthkit.llm.packing import packed
from growthkit.llm.quality import keep_good
from growthkit.llm.repeats import without_repeats
from growthkit.llm.secret_scan import without_secrets

#: Words of a shingle, bytes of a repeated string, and words of one that takes fewer bytes.
SHINGLE, REPEAT, REPEAT_WORDS = 5, 250, 50


def _counted(docs: DataFrame) -> DataFrame:
    """`docs` with n_chars as the text now has."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_good(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id; repeated rows once."""
    kept = near_duplicates(docs, k=SHINGLE).where("kept").groupBy(F.col("doc_id").alias("kept_id"))
    kept = stored(kept.agg(F.count("*").alias("rows")), "kept")
    out = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    if kept.where("rows > 1").isEmpty():
        return out
    return out.dropDuplicates(["doc_id", "text"])


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that also stand elsewhere; a text may end up empty."""
    return _counted(without_repeats(docs, length=REPEAT, words=REPEAT_WORDS))


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in the place of each secret."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return _counted(without_secrets(docs, path, public_tokenizers.PATTERN))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of 2048 tokens."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicate", near_duplicate),
    ("repeats", repeats),
    ("secret", secret),
    ("packing", packing),
]

#: Near duplicates and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
