"""Connected components by alternating large-star and small-star passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared scratch folder and read again, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))")).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each node of `edges` can reach.

    Only nodes with an edge to another node appear. A pass joins edges with one smallest neighbour
    per node, so a node with many neighbours is never gathered; the number of passes grows with the
    logarithm of the longest path. Passes run when this is called.
    """
    pair = edges.where(f"`{a}` <> `{b}`").select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    ).distinct()
    pair = stored(pair, "edges")
    before = _fingerprint(pair)
    while before[0]:
        both = pair.unionByName(pair.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        smallest = both.groupBy("hi").agg(F.min("lo").alias("least")).withColumn("least", F.least("hi", "least"))
        large = both.join(smallest, "hi").where("lo > hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        large = stored(large.where("hi <> lo").distinct(), "edges")
        smallest = large.groupBy("hi").agg(F.min("lo").alias("least"))
        moved = large.join(smallest, "hi").where("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        pair = stored(moved.unionByName(smallest.withColumnRenamed("least", "lo")).distinct(), "edges")
        now = _fingerprint(pair)
        if now == before:
            break
        before = now
    roots = pair.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return pair.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
