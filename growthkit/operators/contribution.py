"""Where a change of revenue comes from: by segment and by factor."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthkit.functions.columns import ratio, with_share
from growthkit.operators.metrics import with_users

Span = tuple[dt.date, dt.date]


def _in(ts: str, span: Span) -> Column:
    """Half-open span: from the first day up to, not including, the last."""
    return (F.col(ts) >= F.lit(span[0])) & (F.col(ts) < F.lit(span[1]))


def _per_user(events: DataFrame, user: str, ts: str, revenue: Column, before: Span, after: Span) -> DataFrame:
    rows = events.where((_in(ts, before) | _in(ts, after)) & F.col(user).isNotNull()).select(
        F.col(user), _in(ts, after).alias("__after"), revenue.cast("double").alias("__r")
    )
    return rows.groupBy(user, "__after").agg(F.sum("__r").alias("__r"), F.count("__r").alias("__paid"))


def contribution(
    events: DataFrame,
    user: str,
    ts: str,
    revenue: Column,
    before: Span,
    after: Span,
    dim: str,
    users: DataFrame | None = None,
) -> DataFrame:
    """Change of revenue by segment -> dim, before, after, change, share.

    Shares are of the total change and add up to 1. `dim` is a column of `users`, or of
    `events` when `users` is left out.
    """
    if users is not None:
        base = with_users(_per_user(events, user, ts, revenue, before, after), users, user, [dim])
    else:
        base = events.where(_in(ts, before) | _in(ts, after)).select(
            dim, _in(ts, after).alias("__after"), revenue.cast("double").alias("__r")
        )
    amount = F.coalesce(F.col("__r"), F.lit(0.0))
    sums = base.groupBy(dim).agg(
        F.sum(F.when(~F.col("__after"), amount).otherwise(0.0)).alias("before"),
        F.sum(F.when(F.col("__after"), amount).otherwise(0.0)).alias("after"),
    )
    return with_share(sums.withColumn("change", F.col("after") - F.col("before")), "change")


def decompose(
    events: DataFrame, user: str, ts: str, revenue: Column, before: Span, after: Span
) -> DataFrame:
    """Split a revenue change over audience, payer share and ARPPU -> one row per factor.

    -> factor, before, after, effect. Revenue = active users x payer share x revenue per payer. Each factor gets
    L(R1, R0) * ln(x1 / x0) with the logarithmic mean L, so effects add up
    to the change exactly. If a factor is 0 in a period the effects are NULL.
    """
    sums = _per_user(events, user, ts, revenue, before, after).agg(
        *[
            agg
            for tag, when in (("0", ~F.col("__after")), ("1", F.col("__after")))
            for agg in (
                F.count_if(when).cast("double").alias(f"u{tag}"),
                F.count_if(when & (F.col("__paid") > 0)).cast("double").alias(f"p{tag}"),
                F.coalesce(F.sum(F.when(when, F.col("__r"))), F.lit(0.0)).alias(f"r{tag}"),
            )
        ]
    )
    r0, r1 = F.col("r0"), F.col("r1")
    mean = F.when(r0 == r1, r0).when((r0 > 0) & (r1 > 0), ratio(r1 - r0, F.ln(ratio(r1, r0))))
    factors = {
        "audience": (F.col("u0"), F.col("u1")),
        "payer_share": (ratio(F.col("p0"), F.col("u0")), ratio(F.col("p1"), F.col("u1"))),
        "arppu": (ratio(r0, F.col("p0")), ratio(r1, F.col("p1"))),
    }
    lines = [
        F.struct(
            F.lit(name).alias("factor"),
            x0.alias("before"),
            x1.alias("after"),
            F.when((x0 > 0) & (x1 > 0), mean * F.ln(ratio(x1, x0))).alias("effect"),
        )
        for name, (x0, x1) in factors.items()
    ]
    lines.append(
        F.struct(F.lit("revenue").alias("factor"), r0.alias("before"), r1.alias("after"), (r1 - r0).alias("effect"))
    )
    return sums.select(F.inline(F.array(*lines)))
