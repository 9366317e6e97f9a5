"""Listings that open and close: how long they stay, when, and where."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from growthkit.functions.columns import names, ratio
from growthkit.functions.quantiles import distribution
from growthkit.operators.explore import top_k
from growthkit.operators.prepare import band_of


def two_way(df: DataFrame, col: str, city: str, *, rest: str = "rest", name: str = "place") -> DataFrame:
    """Label each row as the city or its surroundings; an unknown place counts as surroundings."""
    return df.withColumn(name, F.when(F.col(col) == city, F.lit(city)).otherwise(F.lit(rest)))


def days_active(opened: str, closed: str) -> Column:
    return F.datediff(F.col(closed), F.col(opened))


def activity_segments(
    df: DataFrame,
    opened: str,
    closed: str,
    edges: Sequence[int],
    labels: Sequence[str],
    dims: str | Sequence[str],
    price: str,
    exact: bool = True,
) -> DataFrame:
    """Listings by how long they stayed -> dims, band, n, share, mean_price, median_price.

    A listing without a closing date is in the band `open`. Shares add up to 1 within `dims`.
    """
    dims = names(dims)
    rows = df.select(
        *dims,
        band_of(days_active(opened, closed), edges, labels, none_label="open").alias("band"),
        F.col(price).cast("double").alias("price"),
    )
    spread = distribution(rows, "price", {"median_price": 0.5}, [*dims, "band"], exact)
    return spread.select(
        *dims,
        "band",
        F.col("n_rows").alias("n"),
        ratio(F.col("n_rows"), F.sum("n_rows").over(W.partitionBy(*dims))).alias("share"),
        F.col("mean").alias("mean_price"),
        "median_price",
    )


def seasonality(df: DataFrame, date_cols: dict[str, str], full_years: bool = False) -> DataFrame:
    """Activity by calendar month per kind of date -> kind, month, n, share, rank.

    `date_cols` maps kind to column, such as published and removed. With `full_years`
    only years seen in all twelve months count, so that no month is favoured.
    """
    kinds = list(date_cols)
    dates = df.select(*[F.to_date(c).alias(kind) for kind, c in date_cols.items()])
    monthly = (
        dates.unpivot([], kinds, "kind", "at")
        .where(F.col("at").isNotNull())
        .groupBy("kind", F.year("at").alias("year"), F.month("at").cast("bigint").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if full_years:
        # At most twelve rows per kind and year are left here.
        seen = F.count(F.lit(1)).over(W.partitionBy("kind", "year"))
        monthly = monthly.withColumn("seen", seen).where(F.col("seen") == 12)
    by_month = monthly.groupBy("kind", "month").agg(F.sum("n").alias("n"))
    kind = W.partitionBy("kind")
    return by_month.select(
        "kind",
        "month",
        "n",
        ratio(F.col("n"), F.sum("n").over(kind)).alias("share"),
        F.rank().over(kind.orderBy(F.col("n").desc())).cast("bigint").alias("rank"),
    )


def place_activity(
    df: DataFrame,
    place: str | Sequence[str],
    opened: str,
    closed: str,
    min_n: int = 1,
    top: int | None = None,
) -> DataFrame:
    """Where listings are most active -> place, n, share_removed, avg_days.

    Listings still open count in `n` and in the share, not in the mean days.
    """
    place = names(place)
    out = (
        df.groupBy(*place)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col(closed).isNotNull().cast("double")).alias("share_removed"),
            F.avg(days_active(opened, closed)).alias("avg_days"),
        )
        .where(F.col("n") >= min_n)
    )
    return out if top is None else top_k(out, "n", top, tie=place).drop("rank")
