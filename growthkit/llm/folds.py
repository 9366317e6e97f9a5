"""Which rows a model may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from growthkit.functions.columns import salts_of


def held_out(id: str, folds: int = 5, fold: int = 0) -> Column:
    """True for rows that no model learns from: crc32 of the id as text modulo `folds` is `fold`, or no id."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % folds == fold, F.lit(True))


def sampled_ids(rows: DataFrame, id: str, by: str, most: int) -> DataFrame:
    """(id, by) of at most `most` rows for each value of `by`, the same ones on every run.

    Each of many parts of a value gives its first rows, and the first of those are taken, so that a value with
    most of the rows is never gathered.
    """
    place = F.xxhash64(id)
    parts = rows.select(id, by, F.pmod(place, F.lit(salts_of(rows))).alias("_part"))
    for keys in ([by, "_part"], [by]):
        order = Window.partitionBy(*keys).orderBy(place, id)
        parts = parts.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= most).drop("_place")
    return parts.drop("_part")
