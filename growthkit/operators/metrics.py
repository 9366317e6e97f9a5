"""Product metrics: audience, cohorts, revenue per user, baskets, trends.

Events are first reduced to one row per user and period (or user and session), which
combines inside each task, so one very active user costs no more than any other.
Attributes of users are joined to that reduced table, never to raw events.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from growthkit.functions.columns import exact_sum, names, period_age, period_of, ratio


def with_users(per_user: DataFrame, users: DataFrame | None, user: str, dims: Sequence[str]) -> DataFrame:
    """Add user attributes to rows already reduced per user; an unknown user gets NULL."""
    if users is None or not dims:
        return per_user
    return per_user.join(users.select(F.col(user), *dims), user, "left")


def _own(dims: Sequence[str], users: DataFrame | None) -> list[str]:
    return [] if users is not None else list(dims)


def active_users(
    events: DataFrame,
    user: str,
    ts: str,
    period: str = "month",
    dims: str | Sequence[str] | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Distinct users per period and dim (DAU, WAU, MAU) -> period, dims, users.

    A user seen on two platforms counts once on each; leave `dims` out for the total. Events without a user or a
    time are left out.
    """
    dims = names(dims)
    known = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    seen = known.select(period_of(ts, period).alias("period"), user, *_own(dims, users)).distinct()
    return (
        with_users(seen, users, user, dims)
        .groupBy("period", *dims)
        .agg(F.count(F.lit(1)).alias("users"))
    )


def new_users(
    events: DataFrame, user: str, ts: str, users: DataFrame, channel: str, period: str = "month"
) -> DataFrame:
    """Users by the period of their first event and channel -> period, channel, new_users.

    Events without a user or a time are left out.
    """
    first = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).groupBy(user).agg(F.min(ts).alias("__first"))
    first = first.select(user, period_of("__first", period).alias("period"))
    return with_users(first, users, user, [channel]).groupBy("period", channel).agg(
        F.count(F.lit(1)).alias("new_users")
    )


def dense_ages(
    cells: DataFrame, by: Sequence[str], age: str, value: str, last_age: Column, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per age 0..last_age for each group, 0 where `cells` has no row.

    `cells` is an aggregated table with at most one row per group and age.
    """
    packed = cells.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct(age, value))).alias("__cells"),
        last_age.cast("bigint").alias("__last"),
        *[F.max(c).alias(c) for c in carry],
    )
    ages = packed.where(F.col("__last") >= 0).withColumn(
        age, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__last")))
    )
    zero = F.lit(0).cast(cells.schema[value].dataType)
    return ages.withColumn(value, F.coalesce(F.try_element_at("__cells", F.col(age)), zero)).drop(
        "__cells", "__last"
    )


def retention(
    events: DataFrame,
    user: str,
    ts: str,
    period: str = "month",
    max_age: int | None = None,
    complete_through: dt.date | None = None,
    dims: str | Sequence[str] | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Users of a cohort active exactly `age` periods later -> dims, cohort, age, size, active, rate.

    The cohort is the period of the first event in the whole log; `dims` are columns of `users`.
    `complete_through` is a day in the last complete period, by default in the last one seen: observable cells
    with nobody active are 0, cells after it are absent.
    """
    dims = names(dims)
    known = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    activity = known.select(user, period_of(ts, period).alias("period")).distinct()
    # A user has at most one row per period here, so this window stays small.
    cohort = F.min("period").over(W.partitionBy(user))
    dated = with_users(activity.withColumn("cohort", cohort), users, user, dims)
    cells = (
        dated.groupBy(*dims, "cohort", "period")
        .agg(F.count(F.lit(1)).alias("active"))
        .withColumn("age", period_age(F.col("cohort"), F.col("period"), period))
    )
    if complete_through is None:
        end = known.agg(F.max(period_of(ts, period)).alias("end")).scalar()
    else:
        end = period_of(F.lit(complete_through), period)
    size = F.max(F.when(F.col("age") == 0, F.col("active"))).over(W.partitionBy(*dims, "cohort"))
    cells = cells.select(*dims, "cohort", "period", "age", "active", size.alias("size"))
    last = period_age(F.col("cohort"), end, period)
    if max_age is not None:
        last = F.least(last, F.lit(max_age).cast("bigint"))
    grid = dense_ages(cells.withColumn("__end", last), [*dims, "cohort"], "age", "active", F.max("__end"), carry=["size"])
    return grid.select(*dims, "cohort", "age", "size", "active", ratio(F.col("active"), F.col("size")).alias("rate"))


def _by_period(df: DataFrame, ts: str | None, period: str, dims: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """`df` with the column `period` of `ts`, if one is given, and the columns that results are grouped by."""
    if ts is None:
        return df, list(dims)
    return df.where(F.col(ts).isNotNull()).withColumn("period", period_of(ts, period)), ["period", *dims]


def avg_progress(
    events: DataFrame,
    session: str | Sequence[str],
    done: str,
    total: int | str,
    ts: str | None = None,
    period: str = "month",
    dims: str | Sequence[str] | None = None,
) -> DataFrame:
    """Mean over sessions of the share of levels completed -> period, dims, sessions, avg_progress.

    `done` holds the completed level or NULL; `total` is a number or a column that is
    constant within a session. Each session weighs the same. With `ts` a session counts in the period it
    starts in; `dims` are columns that are constant within a session. Events without a session are left out.
    """
    session, dims = names(session), names(dims)
    whole = [total] if isinstance(total, str) else []
    known = events.dropna(subset=session)
    start = [F.min(ts).alias("__ts")] if ts else []
    per_level = known.groupBy(*session, *dims, done).agg(
        *[F.max(c).alias(c) for c in whole], *start, F.count(F.lit(1)).alias("__n")
    )
    total_of = F.max(total) if whole else F.lit(total)
    start = [F.min("__ts").alias("__ts")] if ts else []
    share = per_level.groupBy(*session, *dims).agg(ratio(F.count(done), total_of).alias("__share"), *start)
    share, group = _by_period(share, "__ts" if ts else None, period, dims)
    return share.groupBy(*group).agg(F.count(F.lit(1)).alias("sessions"), F.avg("__share").alias("avg_progress"))


def revenue_per_user(
    events: DataFrame,
    user: str,
    ts: str,
    revenue: Column,
    period: str = "month",
    dims: str | Sequence[str] | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Revenue, active and paying users per period in one pass.

    -> period, dims, active, payers, revenue, arpau, arppu. `revenue` is NULL on rows that
    are no purchase. ARPAU divides by users active in the period, ARPPU by users
    with a purchase; without payers ARPPU is NULL. Events without a user or a time are left out. `revenue` is exact where it
    comes in whole numbers or decimals.
    """
    dims = names(dims)
    own = _own(dims, users)
    rows = events.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).select(
        user, *own, period_of(ts, period).alias("period"), revenue.alias("__r")
    )
    per_user = rows.groupBy("period", user, *own).agg(exact_sum(rows, "__r").alias("__r"), F.count("__r").alias("__paid"))
    return (
        with_users(per_user, users, user, dims)
        .groupBy("period", *dims)
        .agg(
            F.count(F.lit(1)).alias("active"),
            F.count_if(F.col("__paid") > 0).alias("payers"),
            exact_sum(per_user, "__r").alias("revenue"),
        )
        .withColumn("arpau", ratio(F.col("revenue"), F.col("active")))
        .withColumn("arppu", ratio(F.col("revenue"), F.col("payers")))
    )


def arpau(
    events: DataFrame,
    user: str,
    ts: str,
    revenue: Column,
    period: str = "month",
    dims: str | Sequence[str] | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Revenue per active user -> period, dims, active, revenue, arpau."""
    out = revenue_per_user(events, user, ts, revenue, period, dims, users)
    return out.select("period", *names(dims), "active", "revenue", "arpau")


def share_over(
    events: DataFrame,
    user: str,
    counts: Column,
    k: int,
    ts: str | None = None,
    period: str = "month",
    dims: str | Sequence[str] | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Share of users with strictly more than `k` rows that meet `counts` -> period, dims, users, over, share.

    With `ts` rows are counted within each period. `dims` are columns of `users`, or of the events.
    """
    dims = names(dims)
    rows = events.where(F.col(user).isNotNull()).withColumn("__counts", counts)
    rows, keys = _by_period(rows, ts, period, _own(dims, users))
    per_user = rows.groupBy(*keys, user).agg(F.count_if("__counts").alias("__n"))
    group = (["period"] if ts else []) + dims
    return (
        with_users(per_user, users, user, dims)
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("__n") > k).alias("over"))
        .withColumn("share", ratio(F.col("over"), F.col("users")))
    )


def basket(
    lines: DataFrame,
    order: str | Sequence[str],
    amount: str,
    orders: DataFrame | None = None,
    ts: str | None = None,
    period: str = "month",
    dims: str | Sequence[str] | None = None,
) -> DataFrame:
    """Orders with at least one line -> period, dims, orders, avg_check, avg_items, avg_item_price.

    `ts` and `dims` are columns of `orders`, one row per order, which lines reduced per order are joined to; with
    them, an order missing there is left out of periods and gets NULL dims. Lines without an order are left out.
    """
    order, dims = names(order), names(dims)
    per_order = lines.dropna(subset=order).groupBy(*order).agg(
        F.sum(amount).alias("__amount"), F.count(F.lit(1)).alias("__items")
    )
    if orders is not None:
        per_order = per_order.join(orders.select(*order, *([ts] if ts else []), *dims), order, "left")
    per_order, group = _by_period(per_order, ts, period, dims)
    total = per_order.groupBy(*group).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("__amount").alias("__amount"), F.sum("__items").alias("__items")
    )
    return total.select(
        *group,
        "orders",
        ratio(F.col("__amount"), F.col("orders")).alias("avg_check"),
        ratio(F.col("__items"), F.col("orders")).alias("avg_items"),
        ratio(F.col("__amount"), F.col("__items")).alias("avg_item_price"),
    )


def trend(
    per_period: DataFrame,
    metrics: str | Sequence[str],
    period: str = "period",
    by: str | Sequence[str] | None = None,
    grain: str = "month",
    complete_through: dt.date | None = None,
) -> DataFrame:
    """Change of each metric against the period before.

    -> by, period, <m>, <m>_prev, <m>_change, complete. `per_period` holds one row per period (and
    `by`). A period that follows a gap has no previous value. Periods
    after `complete_through` are kept and flagged, since their totals are partial.
    """
    by, metrics = names(by), names(metrics)
    w = W.partitionBy(*by).orderBy(period)
    follows = period_age(F.lag(period).over(w), F.col(period), grain) == 1
    out = per_period
    for m in metrics:
        out = out.withColumn(f"{m}_prev", F.when(follows, F.lag(m).over(w)))
    for m in metrics:
        out = out.withColumn(f"{m}_change", ratio(F.col(m) - F.col(f"{m}_prev"), F.col(f"{m}_prev")))
    whole = F.lit(True) if complete_through is None else F.col(period) <= F.lit(complete_through)
    extra = [c for m in metrics for c in (m, f"{m}_prev", f"{m}_change")]
    return out.select(*by, period, *extra, whole.alias("complete"))
