"""Pre-aggregated tables for dashboards."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthkit.functions.columns import names


#: Aggregates that can be made from those of finer groups: what a finer group gives, and how these are put together.
PARTS = {
    "count": lambda c: {"n": (F.count(c), F.sum)},
    "sum": lambda c: {"sum": (F.sum(c), F.sum)},
    "min": lambda c: {"min": (F.min(c), F.min)},
    "max": lambda c: {"max": (F.max(c), F.max)},
    "avg": lambda c: {"sum": (F.sum(c), F.sum), "n": (F.count(c), F.sum)},
}

Metric = Column | tuple[str, str | Column]


def mart(
    df: DataFrame,
    dims: str | Sequence[str],
    metrics: dict[str, Metric],
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Metrics for several groupings in one table.

    `sets` lists the groupings, by default every combination of `dims`. `g_<dim>` is
    1 where the row is a total over that dimension, so a NULL category stays
    apart from a total.

    A metric is (count, sum, min, max or avg; column), or any aggregate column. If all are of the first form, rows are aggregated
    once, by the dims that any grouping uses, and the groupings are rolled up from that: only aggregated rows are multiplied. Other
    aggregates cannot be made from finer ones; with any of them every row is copied for each grouping.
    """
    dims = names(dims)
    if sets is None:
        sets = [list(c) for size in range(len(dims), -1, -1) for c in combinations(dims, size)]
    plain = {name: m for name, m in metrics.items() if isinstance(m, Column)}
    if plain:
        out = {name: m if name in plain else getattr(F, m[0])(m[1]) for name, m in metrics.items()}
    else:
        used = [d for d in dims if any(d in s for s in sets)]
        parts = {(name, part): how for name, (kind, c) in metrics.items() for part, how in PARTS[kind](c).items()}
        finest = df.groupBy(*used).agg(*[first.alias(f"__{name}_{part}") for (name, part), (first, _) in parts.items()])
        df = finest.select(*[F.col(d) if d in used else F.lit(None).cast(df.schema[d].dataType).alias(d) for d in dims], *[c for c in finest.columns if c not in used])
        rolled = {key: again(f"__{key[0]}_{key[1]}") for key, (_, again) in parts.items()}
        out = {
            name: F.try_divide(rolled[name, "sum"], rolled[name, "n"]) if kind == "avg" else next(rolled[key] for key in rolled if key[0] == name)
            for name, (kind, _) in metrics.items()
        }
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(d) for d in dims])
    return grouped.agg(
        *[m.alias(name) for name, m in out.items()],
        *[F.grouping(d).cast("bigint").alias(f"g_{d}") for d in dims],
    )
