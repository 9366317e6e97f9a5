"""Neighbouring rows per key when one key may hold a large part of the data.

A plain window over the key would sort a hot key in one task. Rows are therefore
windowed per (key, time slice), the only sort of rows; the first row of each slice is a small
aggregate, and the one of the next slice is joined back to the rows of a slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from growthkit.functions.columns import names
from growthkit.functions.slices import next_heads, slice_of


def with_neighbour(
    df: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    order: str | Sequence[str],
    cols: str | Sequence[str],
    *,
    previous: bool = False,
    grain: str = "hour",
    name: str = "next",
) -> DataFrame:
    """Add the struct `name` with `cols` of the next (or previous) row of the same key.

    Rows are ordered by `ts`, then `order`; together with the key these must be
    unique. The last (first) row of a key gets NULL, and so does a row whose key or time is NULL, which is no row's
    neighbour. `grain` is the time slice: small enough that the rows of one key in it fit a task.
    """
    keys, cols = names(keys), names(cols)
    ordering = [F.col(c).desc() if previous else F.col(c).asc() for c in [ts, *names(order)]]
    inside = W.partitionBy(*keys, "__slice").orderBy(*ordering)
    whole = reduce(and_, [F.col(c).isNotNull() for c in [*keys, ts]])
    seen = df.withColumn("__slice", F.when(whole, slice_of(ts, grain)))
    here = F.when(F.col("__slice").isNotNull(), F.lead(F.struct(*cols)).over(inside))

    # Times alone are aggregated without a sort; other columns need the order of their rows.
    pick, head = F.max if previous else F.min, F.struct(*cols)
    known = seen.where(F.col("__slice").isNotNull()).groupBy(*keys, "__slice")
    if set(cols) == {ts}:
        heads = known.agg(pick(ts).alias("__t")).select(*keys, "__slice", F.struct(F.col("__t").alias(ts)).alias("__head"))
    else:
        first = F.struct(ts, *names(order), head.alias("__head"))
        heads = known.agg(pick(first)["__head"].alias("__head"))
    heads = next_heads(heads, keys, "__slice", "__head", grain, previous)
    heads = heads.select(*[F.col(k).alias(f"__of{i}") for i, k in enumerate(keys)], F.col("__slice").alias("__in"), "__next")
    same = [F.col(k) == F.col(f"__of{i}") for i, k in enumerate(keys)] + [F.col("__slice") == F.col("__in")]
    out = seen.withColumn(name, here).join(heads, same, "left")
    return out.select(*df.columns, F.coalesce(name, F.col("__next.__head")).alias(name))
