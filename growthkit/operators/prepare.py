"""Preprocessing: types, text, missing values, duplicates, extremes, slices, enrichment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthkit.functions.columns import attach, join_groups, known_number, names, to_long
from growthkit.functions.quantiles import quantiles
from growthkit.operators.quality import duplicates


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Convert text columns; what cannot be read becomes NULL and sets `<col>_bad`."""
    out = df
    for col, kind in types.items():
        parsed = F.trim(F.col(col).cast("string")).try_cast(kind)
        out = out.withColumn(f"{col}_bad", F.col(col).isNotNull() & parsed.isNull()).withColumn(col, parsed)
    return out


def normalize(df: DataFrame, cols: str | Sequence[str], replace: dict[str, str] | None = None) -> DataFrame:
    """Category text in one spelling: lower case, single blanks, no blanks at the ends.

    `replace` maps characters to characters, such as one letter variant to another.
    """
    out = df
    for col in names(cols):
        text = F.trim(F.regexp_replace(F.lower(F.col(col)), r"\s+", " "))
        if replace:
            text = F.translate(text, "".join(replace), "".join(replace.values()))
        out = out.withColumn(col, text)
    return out


def fill_missing(
    df: DataFrame,
    cols: dict[str, object] | str | Sequence[str],
    by: str | Sequence[str] | None = None,
    stat: str = "median",
) -> DataFrame:
    """Fill NULLs with a constant (`cols` a dict) or with a statistic of the row's group.

    `stat` is median or mean. A group with no value at all stays NULL. Columns keep their type and known values stay as they are:
    whole numbers and decimals are compared and added up exactly, and a fill is rounded half up to what the type holds. A constant
    that its column cannot hold unchanged is refused.
    """
    if isinstance(cols, dict):
        for col, value in cols.items():
            kind = df.schema[col].dataType
            if isinstance(kind, T.IntegralType) and isinstance(value, float) and value != int(value):
                raise ValueError(f"column {col} of type {kind.simpleString()} cannot hold {value}")
        return df.fillna(cols)
    by, cols = names(by), names(cols)
    if stat not in ("median", "mean"):
        raise ValueError("stat must be median or mean")
    out, group = df, by
    if not by:
        out, group = df.withColumn("__all", F.lit(1)), ["__all"]
    fills = {c: f"__fill_{i}" for i, c in enumerate(cols)}
    exact = [c for c in cols if isinstance(df.schema[c].dataType, (T.IntegralType, T.DecimalType))]
    known = []
    if stat == "median":
        for c in exact:
            known.append(quantiles(out, c, {fills[c]: 0.5}, group, typed=True))
        if real := [c for c in cols if c not in exact]:
            # The others in one long table: one pass over the rows, whatever their number.
            long = to_long(out, group, real, "__name", "__value")
            points = quantiles(long, "__value", {"__fill": 0.5}, [*group, "__name"])
            of_column = [F.max(F.when(F.col("__name") == c, F.col("__fill"))).alias(fills[c]) for c in real]
            known.append(points.groupBy(*group).agg(*of_column))
    else:
        known.append(out.groupBy(*group).agg(*[_mean(df, c).alias(name) for c, name in fills.items()]))
    fill = reduce(lambda left, right: join_groups(left, right, group), known)
    out = attach(out, fill, group)
    filled = {c: F.coalesce(F.col(c), F.col(name).cast(df.schema[c].dataType)) for c, name in fills.items()}
    return out.withColumns(filled).select(*df.columns)


def _mean(df: DataFrame, col: str) -> Column:
    """The mean of a group; of whole numbers and decimals from their exact sum, rounded half up to their scale."""
    kind = df.schema[col].dataType
    if not isinstance(kind, (T.IntegralType, T.DecimalType)):
        return F.avg(known_number(df, col))
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    total = F.sum(F.col(col).cast(f"decimal({30 + min(scale, 6)},{scale})")).cast(f"decimal(38,{scale})")
    return F.round(F.try_divide(total, F.count(col).cast("decimal(20,0)")), scale)


def drop_missing(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Rows in which every one of `cols` is known."""
    return df.dropna(subset=names(cols))


def dedupe(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row per key in the given total order.

    Spark keeps only the first row per key and task before the shuffle, so a key
    with very many copies does not gather in one task.
    """
    order_by = [order_by] if isinstance(order_by, str | Column) else list(order_by)
    first = W.partitionBy(*names(keys)).orderBy(*order_by)
    return df.withColumn("__at", F.row_number().over(first)).where(F.col("__at") == 1).drop("__at")


def slice_(df: DataFrame, where: Column, columns: str | Sequence[str]) -> DataFrame:
    """The rows and columns asked for; both reach the file scan."""
    return df.where(where).select(*names(columns))


def band(
    df: DataFrame,
    col: str,
    edges: Sequence[float],
    labels: Sequence[str] | None = None,
    *,
    none_label: str = "None",
    name: str | None = None,
) -> DataFrame:
    """Label of the band (left open, right closed) that holds the value.

    `n` edges, in rising order, make `n + 1` bands, the outer ones unbounded. NULL and NaN get `none_label`.
    """
    return df.withColumn(name or f"{col}_band", band_of(F.col(col), edges, labels, none_label))


def band_of(
    value: Column, edges: Sequence[float], labels: Sequence[str] | None = None, none_label: str = "None"
) -> Column:
    edges = list(edges)
    if not edges:
        raise ValueError("at least one edge is needed")
    if any(low >= high for low, high in zip(edges, edges[1:])):
        raise ValueError(f"edges must rise, got {edges}")
    if labels is None:
        middle = [f"({low}, {high}]" for low, high in zip(edges, edges[1:])]
        labels = [f"<={edges[0]}", *middle, f">{edges[-1]}"]
    if len(labels) != len(edges) + 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) + 1} labels, got {len(labels)}")
    out = F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(none_label))
    for edge, label in zip(edges, labels):
        out = out.when(value <= F.lit(edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def fence(
    df: DataFrame,
    col: str,
    lo: float = 0.01,
    hi: float = 0.99,
    by: str | Sequence[str] | None = None,
    exact: bool = True,
) -> DataFrame:
    """Rows whose value lies between two quantiles, ends included. NULL values are left out."""
    by = names(by)
    edges = quantiles(df, col, {"__lo": lo, "__hi": hi}, by, exact)
    if by:
        inside = attach(df, edges, by).where(F.col(col).between(F.col("__lo"), F.col("__hi")))
        return inside.drop("__lo", "__hi")
    one = edges.select(F.struct("__lo", "__hi").alias("edges")).scalar()
    return df.where(F.col(col).between(one["__lo"], one["__hi"]))


def enrich(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], *, how: str = "left", check: bool = True
) -> DataFrame:
    """Add a second table's columns to each row.

    With `check` the job fails if a key of `right` repeats, since that would multiply rows of `left`.
    Keys with a NULL never join, so they may repeat.
    """
    on = names(on)
    out = left.join(right, on, how)
    if not check:
        return out
    surplus = duplicates(right.dropna(subset=on), on).select("surplus").scalar()
    message = F.concat(F.lit(f"{on} is not a key of the right table, surplus rows: "), surplus.cast("string"))
    return out.where(F.when(surplus > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def flag_exists(df: DataFrame, other: DataFrame, on: str | Sequence[str], name: str) -> DataFrame:
    """Boolean column: does the row's key occur in `other`?"""
    on = names(on)
    found = other.select(*on).distinct().withColumn(name, F.lit(True))
    return df.join(found, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
