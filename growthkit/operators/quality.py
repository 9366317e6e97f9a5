"""Getting to know a table and checking it: reports, no changes to the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthkit.functions.columns import names, ratio


#: Bits of a sketch of distinct values: 2 ** 12 registers, a standard error of about 1.6 %.
SKETCH_BITS = 12


def profile(df: DataFrame, cols: str | Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Rows, NULLs and distinct values per column -> col, n, nulls, n_distinct.

    Distinct values are estimated from `profile_sketches`: one pass, and no value leaves its task. With `exact` each column is
    counted by its values, of its own type, in a pass that reads that column alone; values equal to Spark are one value, also 0.0
    and -0.0, or two NaN.
    """
    cols = names(cols) or df.columns
    if not exact:
        return profile_of(profile_sketches(df, cols))
    counted = []
    for c in cols:
        values = df.select(F.col(c).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        one = values.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("v").alias("n_distinct"),
        )
        counted.append(one.select(F.lit(c).alias("col"), "n", "nulls", "n_distinct"))
    return reduce(DataFrame.unionByName, counted)


def profile_sketches(df: DataFrame, cols: str | Sequence[str] | None = None) -> DataFrame:
    """A mergeable profile to be stored, one of each day or file for instance -> col, n, nulls, sketch.

    The sketch is a HyperLogLog of the column's values; `profile_of` puts any number of them together.
    """
    cols = names(cols) or df.columns

    def sketched(c: str) -> Column:
        kind = df.schema[c].dataType
        # adding 0.0 makes one value of 0.0 and -0.0
        value = F.col(c) + F.lit(0.0) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(c)
        plain = isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
        return F.hll_sketch_agg(value if plain else value.cast("string"), SKETCH_BITS)

    parts = [
        F.struct(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col(c).isNull()).alias("nulls"), sketched(c).alias("sketch")
        ).alias(f"__{i}")
        for i, c in enumerate(cols)
    ]
    lines = F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"__{i}.n"), F.col(f"__{i}.nulls"), F.col(f"__{i}.sketch")) for i, c in enumerate(cols)])
    return df.agg(*parts).select(F.inline(lines))


def profile_of(sketches: DataFrame) -> DataFrame:
    """The profile that stored sketches add up to -> col, n, nulls, n_distinct (estimated)."""
    return sketches.groupBy("col").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"),
    )


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each named rule -> rule, violations, share.

    A rule that evaluates to NULL counts as broken.
    """
    kept = list(rules)
    broken = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(~F.coalesce(rules[name], F.lit(False))).alias(name) for name in kept],
    )
    return broken.unpivot(["__n"], kept, "rule", "violations").select(
        "rule", "violations", ratio(F.col("violations"), F.col("__n")).alias("share")
    )


def duplicates(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """How far `keys` is from being a key -> n_rows, n_keys, surplus."""
    per_key = df.groupBy(*names(keys)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).withColumn("surplus", F.col("n_rows") - F.col("n_keys"))


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Child rows whose key is missing in the parent; `on` maps child to parent column.

    A NULL key points to nothing, so its rows are returned too.
    """
    keys = parent.select(*[F.col(p).alias(f"__{c}") for c, p in on.items()])
    same = [F.col(c) == F.col(f"__{c}") for c in on]
    return child.join(keys, same, "left_anti")


def orphan_report(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Number of orphans -> n_keys, n_rows. Child rows are counted per key before the join."""
    per_key = child.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    return orphans(per_key, parent, on).agg(
        F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows")
    )
