"""Unit economics per acquisition source: LTV, CAC, ROI, payback."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from growthkit.functions.columns import exact_sum, join_groups, names, period_end, period_of, ratio
from growthkit.operators.metrics import dense_ages, revenue_per_user, trend, with_users


def within_age(
    events: DataFrame, start: DataFrame, user: str, ts: str, start_ts: str, max_age: int
) -> DataFrame:
    """Events of the first `max_age` days of each user, with `age` in days.

    `start` has one row per user with its first day in `start_ts`. Events are read once and meet the first days in a join on the
    user, which adaptive execution splits for a very active one. Where events are stored in buckets of the user
    (`sources.tables.write_bucketed`), they are joined where they lie. Events without a user or a time are left out.
    """
    first = start.select(user, F.to_date(start_ts).alias("__first"))
    age = F.datediff(F.to_date(ts), "__first").cast("bigint")
    aged = events.join(first, user).select(*events.columns, age.alias("age"))
    return aged.where(F.col("age").between(0, max_age - 1))


def daily_revenue(events: DataFrame, user: str, ts: str, revenue: Column) -> DataFrame:
    """Revenue per user and age in days since the first event -> user, first_day, age, revenue.

    Events are summed per user and day before the first day is looked up; whole numbers and decimals exactly. Events without a user
    or a time are left out.
    """
    known = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    rows = known.select(user, F.to_date(ts).alias("__day"), revenue.alias("__r"))
    per_day = rows.groupBy(user, "__day").agg(exact_sum(rows, "__r").alias("revenue"))
    first = F.min("__day").over(W.partitionBy(user))
    return per_day.withColumn("first_day", first).select(
        user, "first_day", F.datediff("__day", "first_day").cast("bigint").alias("age"), "revenue"
    )


def ltv_curve(
    events: DataFrame,
    user: str,
    ts: str,
    revenue: Column,
    users: DataFrame | None = None,
    dim: str | Sequence[str] | None = None,
    max_age: int = 28,
    observed_through: dt.date | None = None,
    cohort: str | None = None,
) -> DataFrame:
    """Cumulative revenue per acquired user by age -> dim, cohort, age, users, revenue, ltv, acquired.

    Ages run from 0 to max_age-1. Users whose last of these days lies after `observed_through` (by
    default the last day in the log) do not take part: their curve is not finished. Revenue is
    divided by all users that take part, paying or not; `acquired` counts those left out too. With `cohort`, a
    period, results are also by the period of the first event, and only whole cohorts take part.
    """
    dim = names(dim)
    if observed_through is None:
        end = events.agg(F.max(F.to_date(ts)).alias("end")).scalar()
    else:
        end = F.lit(observed_through)
    daily = daily_revenue(events, user, ts, revenue).where(F.col("age") < max_age)
    keyed = with_users(daily, users, user, dim)
    last_start = F.col("first_day")
    if cohort:
        keyed = keyed.withColumn("cohort", period_of("first_day", cohort))
        dim = [*dim, "cohort"]
        last_start = F.date_sub(period_end(F.col("cohort"), cohort), 1)
    keyed = keyed.withColumn("__done", F.date_add(last_start, max_age - 1) <= end)
    group = dim
    if not dim:
        keyed, group = keyed.withColumn("__all", F.lit(1)), ["__all"]
    first = F.col("age") == 0
    cells = keyed.groupBy(*group, "age").agg(
        exact_sum(keyed, "revenue", F.when(F.col("__done"), F.col("revenue"))).alias("revenue"),
        F.count_if(first & F.col("__done")).alias("users"),
        F.count_if(first).alias("acquired"),
    )
    grid = dense_ages(
        cells, group, "age", "revenue", F.lit(max_age - 1).cast("bigint"), carry=["users", "acquired"]
    ).where(F.col("users") > 0)
    so_far = W.partitionBy(*group).orderBy("age").rowsBetween(W.unboundedPreceding, W.currentRow)
    out = grid.withColumn("revenue", F.sum("revenue").over(so_far))
    ltv = ratio(F.col("revenue"), F.col("users")).alias("ltv")
    return out.select(*dim, "age", "users", "revenue", ltv, "acquired")


def cac(users: DataFrame, costs: DataFrame, dim: str | Sequence[str], cost: str = "cost") -> DataFrame:
    """Spend per acquired user by source -> dim, users, cost, cac.

    `users` has one row per acquired user. A source with spend and no users, or users and no spend,
    stays in the result with NULL for CAC. `dim` may be several columns, a cohort among them.
    """
    dim = names(dim)
    acquired = users.groupBy(*dim).agg(F.count(F.lit(1)).alias("users"))
    spend = costs.groupBy(*dim).agg(F.sum(cost).cast("double").alias("cost"))
    both = acquired.join(spend, dim, "full")
    return both.select(
        *dim,
        F.coalesce("users", F.lit(0)).alias("users"),
        "cost",
        ratio(F.col("cost"), F.col("users")).alias("cac"),
    )


def roi_curve(ltv: DataFrame, costs: DataFrame, dim: str | Sequence[str], cost: str = "cost") -> DataFrame:
    """(LTV - CAC) / CAC by age -> dim, age, users, ltv, cac, roi.

    CAC divides the spend by all users it acquired, also those too young for the LTV (`acquired` of
    `ltv_curve`). Where spend is dated, name the cohort among `dim`, so that each cohort meets its own spend.
    """
    dim = names(dim)
    spend = costs.groupBy(*dim).agg(F.sum(cost).cast("double").alias("__cost"))
    with_cac = join_groups(ltv, spend, dim).withColumn("cac", ratio(F.col("__cost"), F.col("acquired")))
    return with_cac.select(
        *dim, "age", "users", "ltv", "cac", ratio(F.col("ltv") - F.col("cac"), F.col("cac")).alias("roi")
    )


def payback(roi: DataFrame, dim: str | Sequence[str]) -> DataFrame:
    """First age with ROI of at least 0 per source -> dim, payback_age, paid_back, last_roi."""
    return roi.groupBy(*names(dim)).agg(
        F.min(F.when(F.col("roi") >= 0, F.col("age"))).alias("payback_age"),
        F.coalesce(F.max(F.col("roi") >= 0), F.lit(False)).alias("paid_back"),
        F.max_by("roi", "age").alias("last_roi"),
    )


def arppu(
    events: DataFrame,
    user: str,
    ts: str,
    revenue: Column,
    period: str = "month",
    dims: str | Sequence[str] | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Revenue per paying user -> period, dims, payers, revenue, arppu."""
    out = revenue_per_user(events, user, ts, revenue, period, dims, users)
    return out.select("period", *names(dims), "payers", "revenue", "arppu")


def trend_by_source(
    events: DataFrame,
    user: str,
    ts: str,
    revenue: Column,
    source: str,
    users: DataFrame | None = None,
    period: str = "month",
    complete_through: dt.date | None = None,
) -> DataFrame:
    """Revenue and audience per source and period with the change against the period before."""
    per_period = revenue_per_user(events, user, ts, revenue, period, [source], users)
    return trend(
        per_period,
        ["revenue", "active"],
        by=[source],
        grain=period,
        complete_through=complete_through,
    )
