"""Time slices of a key, and nodes above them, so that nothing is ever ordered or gathered by a key alone.

Slices have a fixed length and are numbered from the year 1. A node holds as many neighbouring slices of a key as
`radix` says, a node above it as many nodes, until one holds all times that Spark has. Whatever runs along the
slices of a key runs inside its nodes, then along the nodes, a level at a time; a window or a list has at most MOST rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

# Seconds of a slice. Months and longer are lengths like any other here: slices only cut the work.
_DAY = 24 * 3600
GRAINS = {
    "second": 1,
    "minute": 60,
    "hour": 3600,
    "day": _DAY,
    "week": 7 * _DAY,
    "month": 30 * _DAY,
    "quarter": 91 * _DAY,
    "year": 365 * _DAY,
}
#: Microseconds from the year 1 to 1970, the years that times may lie in, and the most rows of a node.
SINCE, YEARS, MOST = 62_135_596_800_000_000, 10_000, 10_000


def micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def slice_of(ts: str | Column, grain: str) -> Column:
    """The number of the slice that holds `ts`."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {tuple(GRAINS)}, got {grain!r}")
    return F.call_function("div", micros(ts) + SINCE, F.lit(GRAINS[grain] * 1_000_000))


def radix(grain: str) -> tuple[int, int]:
    """(rows of a node, levels of nodes) so that the last level is one node."""
    slices = YEARS * 366 * _DAY // GRAINS[grain] + 1
    levels = max(1, math.ceil(math.log(slices) / math.log(MOST)))
    return math.ceil(slices ** (1 / levels)), levels


def node_of(at: str, grain: str) -> Column:
    """The node of a slice, or of a node one level below."""
    return F.expr(f"`{at}` div {radix(grain)[0]}")


def joined(rows: DataFrame, nodes: DataFrame, keys: Sequence[str], here: str, there: str, cols: Sequence[str]) -> DataFrame:
    """`rows` with `cols` of the node whose number `there` is in `here`; every row has one."""
    right = nodes.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(there).alias("__k"), *cols)
    same = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)] + [F.col(here) == F.col("__k")]
    return rows.join(right, same).drop("__k", *[f"__k{i}" for i in range(len(keys))])


def next_heads(
    heads: DataFrame, keys: Sequence[str], at: str, value: str, grain: str, previous: bool = False, levels: int | None = None
) -> DataFrame:
    """`heads`, a row for each key and slice, with `__next`: `value` of the key's next (or previous) slice that has a row."""
    levels = radix(grain)[1] if levels is None else levels
    order = F.col(at).desc() if previous else F.col(at).asc()
    rows = heads.withColumn("__node", node_of(at, grain))
    inside = W.partitionBy(*keys, "__node").orderBy(order)
    rows = rows.withColumn("__next", F.lead(F.struct(value)).over(inside))
    if levels > 1:
        first = (F.max if previous else F.min)(F.struct(at, value))
        nodes = rows.groupBy(*keys, "__node").agg(first.alias("__first"))
        nodes = nodes.select(*keys, F.col("__node").alias("__up"), F.col(f"__first.{value}").alias("__head"))
        nodes = next_heads(nodes, keys, "__up", "__head", grain, previous, levels - 1)
        nodes = nodes.withColumn("__above", F.when(F.col("__next").isNotNull(), F.struct(F.col("__next.__head").alias(value))))
        rows = joined(rows, nodes, keys, "__node", "__up", ["__above"])
        rows = rows.withColumn("__next", F.coalesce("__next", "__above")).drop("__above")
    return rows.drop("__node")
