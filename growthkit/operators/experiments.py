"""Experiment design, hygiene checks and tests.

Rows are reduced to counts, means and variances per group by Spark; only those few
result rows meet the probability functions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from growthkit.functions import stats
from growthkit.functions.columns import ratio


# Places that 12 hexadecimal digits of a digest can take.
PLACES = 16**12


def sample_size(baseline: float, mde: float, alpha: float = 0.05, power: float = 0.8) -> int:
    """Users per group to see a rate move from `baseline` by `mde` (absolute), two-sided."""
    p1, p2 = baseline, baseline + mde
    if mde == 0:
        raise ValueError("mde must not be 0: no sample is large enough")
    if not (0 < p1 < 1 and 0 < p2 < 1):
        raise ValueError(f"rates must lie between 0 and 1, got {p1} and {p2}")
    z = stats.z_quantile(1 - alpha / 2) + stats.z_quantile(power)
    return math.ceil(z * z * (p1 * (1 - p1) + p2 * (1 - p2)) / (mde * mde))


def ab_design(
    daily: DataFrame,
    user: str,
    day: str,
    success: str,
    mde: float,
    alpha: float = 0.05,
    power: float = 0.8,
    groups: int = 2,
) -> DataFrame:
    """Parameters of a test on a rate -> baseline, daily_users, n_per_group, days.

    `daily` has user activity by day with a boolean `success`. A test of d days reaches the distinct users of
    the first d days of the log, and its baseline is the share of them with a success in those days; `days` is
    the smallest d that reaches `groups` times the users its baseline asks for. If the log never does, `days` is
    NULL and the other columns are those of the whole log. `daily_users` is the mean number of users a day. A
    baseline of 0 or 1, or one that `mde` moves out of (0, 1), gives NULL sizes. Rows without a user or a day
    are left out.
    """
    if mde == 0:
        raise ValueError("mde must not be 0: no sample is large enough")
    known = daily.where(F.col(user).isNotNull() & F.col(day).isNotNull())
    per_day = known.groupBy(F.to_date(day).alias("__day"), F.col(user)).agg(F.max(success).alias("__ok"))
    traffic = per_day.groupBy("__day").agg(F.count(F.lit(1)).alias("__n"))
    first = per_day.groupBy(user).agg(
        F.min("__day").alias("__seen"), F.min(F.when(F.col("__ok"), F.col("__day"))).alias("__won")
    )
    came = first.groupBy(F.col("__seen").alias("__day")).agg(F.count(F.lit(1)).alias("__came"))
    won = first.where(F.col("__won").isNotNull()).groupBy(F.col("__won").alias("__day"))
    won = won.agg(F.count(F.lit(1)).alias("__wins"))
    # One row per day of the log, so the window over all of them is small.
    so_far = W.orderBy("__day").rowsBetween(W.unboundedPreceding, W.currentRow)
    days = traffic.join(came, "__day", "left").join(won, "__day", "left")
    reach = F.sum(F.coalesce("__came", F.lit(0))).over(so_far)
    wins = F.sum(F.coalesce("__wins", F.lit(0))).over(so_far)
    length = F.datediff("__day", F.min("__day").over(so_far)).cast("bigint") + 1
    days = days.select("__n", reach.alias("__reach"), ratio(wins, reach).alias("baseline"), length.alias("__d"))
    p1, p2 = F.col("baseline"), F.col("baseline") + F.lit(float(mde))
    z = stats.z_quantile(1 - alpha / 2) + stats.z_quantile(power)
    n = F.lit(z * z / (mde * mde)) * (p1 * (1 - p1) + p2 * (1 - p2))
    usable = (p1 > 0) & (p1 < 1) & (p2 > 0) & (p2 < 1)
    days = days.withColumn("n_per_group", F.when(usable, F.ceil(n)))
    enough = F.col("__reach") >= F.col("n_per_group") * groups
    line = F.struct("baseline", "n_per_group", F.col("__d").alias("days"))
    best = days.agg(
        F.avg("__n").alias("daily_users"),
        F.min_by(line, F.when(enough, F.col("__d"))).alias("__met"),
        F.max_by(line, "__d").alias("__all"),
    )
    met = F.col("__met").isNotNull()
    return best.select(
        F.when(met, F.col("__met.baseline")).otherwise(F.col("__all.baseline")).alias("baseline"),
        "daily_users",
        F.when(met, F.col("__met.n_per_group")).otherwise(F.col("__all.n_per_group")).alias("n_per_group"),
        F.col("__met.days").alias("days"),
    )


def assign(df: DataFrame, user: str, salt: str, weights: dict[str, float], name: str = "group") -> DataFrame:
    """Give each user a group by a hash of salt and user: stable, and the same on any engine.

    Another salt gives an independent split. Weights need not add up to 1; a group's share is met
    to within 2**-48, so very small groups get their users too.
    """
    total = sum(weights.values())
    if not weights or min(weights.values()) < 0 or total <= 0:
        raise ValueError("weights must not be negative and must have a positive sum")
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.col(user).cast("string")))
    place = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    out, edge, last = None, 0.0, list(weights)[-1]
    for group, weight in weights.items():
        edge += weight
        if group != last:
            inside = place < F.lit(round(PLACES * edge / total))
            out = F.when(inside, F.lit(group)) if out is None else out.when(inside, F.lit(group))
    picked = F.lit(last) if out is None else out.otherwise(F.lit(last))
    return df.withColumn(name, F.when(F.col(user).isNotNull(), picked))


def ab_prepare(
    sessions: DataFrame,
    user: str,
    group: str,
    started: str,
    ended: str,
    groups: Sequence[str] | None = None,
) -> DataFrame:
    """One row per user with total active time -> user, group, seconds, n_sessions.

    `groups` keeps the cities under comparison. A user seen in several groups keeps one row
    per group, for `overlap` to find. A session that ends before it starts counts 0. Sessions without a user are left out.
    """
    rows = sessions.where(F.col(user).isNotNull())
    rows = rows if groups is None else rows.where(F.col(group).isin(list(groups)))
    micros = F.unix_micros(F.col(ended).cast("timestamp")) - F.unix_micros(F.col(started).cast("timestamp"))
    length = F.greatest(F.floor(micros / 1_000_000), F.lit(0))
    return rows.groupBy(user, group).agg(
        F.coalesce(F.sum(length), F.lit(0)).alias("seconds"), F.count(F.lit(1)).alias("n_sessions")
    )


def overlap(df: DataFrame, user: str, group: str) -> DataFrame:
    """Users in more than one group -> user, n_groups. Rows without a user or a group are left out."""
    pairs = df.where(F.col(group).isNotNull() & F.col(user).isNotNull()).select(user, group).distinct()
    return pairs.groupBy(user).agg(F.count(F.lit(1)).alias("n_groups")).where(F.col("n_groups") > 1)


def srm(df: DataFrame, group: str, weights: dict[str, float], user: str | None = None) -> DataFrame:
    """Do group sizes fit the planned split? -> n, groups, unplanned, chi2, p.

    With `user` given, users are counted, and rows without one are left out; otherwise rows are. A planned group without users counts as 0. Rows
    (or users) whose group is not planned, or unknown, are no part of the test but are counted in `unplanned`:
    any of them means that the assignment did not follow the plan.
    """
    total = sum(weights.values())
    kept = df.where(F.col(user).isNotNull()).select(user, group).distinct() if user else df
    labels = list(weights)
    planned = F.coalesce(F.col(group).isin(labels), F.lit(False))
    sizes = kept.agg(
        F.count_if(~planned).alias("unplanned"),
        *[F.count_if(F.col(group) == g).cast("double").alias(f"__g{i}") for i, g in enumerate(labels)],
    )
    n = sum((F.col(f"__g{i}") for i in range(len(labels))), F.lit(0.0))
    chi2 = F.lit(0.0)
    for i, g in enumerate(labels):
        expected = n * F.lit(weights[g] / total)
        chi2 = chi2 + ratio((F.col(f"__g{i}") - expected) * (F.col(f"__g{i}") - expected), expected)
    groups = F.lit(len(labels)).cast("bigint")
    out = sizes.select(n.cast("bigint").alias("n"), groups.alias("groups"), "unplanned", chi2.alias("chi2"))
    return out.withColumn("p", stats.chi2_pvalue(F.col("chi2"), (F.col("groups") - 1).cast("double")))


def one_row_per_user(df: DataFrame, user: str, group: str, cols: Sequence[str]) -> DataFrame:
    """Fail the job if a user repeats, since tests take the user as the unit. Rows without a user are left out."""
    merged = df.where(F.col(user).isNotNull()).groupBy(user).agg(
        F.count(F.lit(1)).alias("__n"), F.first(group).alias("__g"), *[F.first(c).alias(c) for c in cols]
    )
    message = F.concat(F.lit("user occurs more than once: "), F.col(user).cast("string"))
    checked = F.when(F.col("__n") > 1, F.raise_error(message)).otherwise(F.col("__g"))
    return merged.select(user, checked.alias(group), *cols)


def _sides(df: DataFrame, group: str, cols: Sequence[str], a: object, b: object) -> DataFrame:
    """Size, mean and variance of both groups -> metric, n_a, n_b, mean_a, mean_b, var_a, var_b."""
    cols = list(cols)
    long = df.where(F.col(group).isin([a, b])).select(
        (F.col(group) == F.lit(b)).alias("__b"), *[F.col(c).cast("double").alias(c) for c in cols]
    )
    long = long.unpivot(["__b"], cols, "metric", "__x")
    both = []
    for tag, inside in (("a", ~F.col("__b")), ("b", F.col("__b"))):
        x = F.when(inside & ~F.isnan("__x"), F.col("__x"))
        both += [F.count(x).alias(f"n_{tag}"), F.avg(x).alias(f"mean_{tag}"), F.var_samp(x).alias(f"var_{tag}")]
    return long.groupBy("metric").agg(*both)


def _bounds(diff: Column, margin: Column, alternative: str) -> list[Column]:
    inf = F.lit(float("inf"))
    low = -inf if alternative == "less" else diff - margin
    high = inf if alternative == "greater" else diff + margin
    return [low.alias("ci_lo"), high.alias("ci_hi")]


def _welch_columns(alternative: str, alpha: float) -> list[Column]:
    va, vb = ratio(F.col("var_a"), F.col("n_a")), ratio(F.col("var_b"), F.col("n_b"))
    se = F.sqrt(va + vb)
    diff = F.col("mean_b") - F.col("mean_a")
    t = ratio(diff, se)
    df = ratio(
        (va + vb) * (va + vb),
        ratio(va * va, F.col("n_a") - 1) + ratio(vb * vb, F.col("n_b") - 1),
    )
    level = 1 - alpha / 2 if alternative == "two-sided" else 1 - alpha
    return [
        diff.alias("diff"),
        t.alias("t"),
        df.alias("df"),
        stats.t_pvalue(t, df, alternative).alias("p"),
        *_bounds(diff, stats.t_critical(level, df) * se, alternative),
    ]


def welch(
    df: DataFrame,
    group: str,
    x: str,
    a: object,
    b: object,
    alternative: str = "two-sided",
    alpha: float = 0.05,
    user: str | None = None,
) -> DataFrame:
    """Difference of means b - a without assuming equal variances.

    -> n_a, n_b, mean_a, mean_b, diff, t, df, p, ci_lo, ci_hi. `greater` asks whether b is greater
    than a. NULL and NaN values are left out, with `user` also rows without one. With `user` given the job fails if a user occurs twice.
    """
    stats.check_alternative(alternative)
    rows = one_row_per_user(df, user, group, [x]) if user else df
    sides = _sides(rows, group, [x], a, b)
    return sides.select("n_a", "n_b", "mean_a", "mean_b", *_welch_columns(alternative, alpha))


def _ztest_columns(alternative: str, alpha: float) -> list[Column]:
    pa, pb = F.col("mean_a"), F.col("mean_b")
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    pooled = ratio(pa * na + pb * nb, na + nb)
    z = ratio(pb - pa, F.sqrt(pooled * (1 - pooled) * (ratio(F.lit(1.0), na) + ratio(F.lit(1.0), nb))))
    spread = F.sqrt(ratio(pa * (1 - pa), na) + ratio(pb * (1 - pb), nb))
    level = 1 - alpha / 2 if alternative == "two-sided" else 1 - alpha
    diff = pb - pa
    return [
        diff.alias("diff"),
        z.alias("z"),
        stats.z_pvalue(z, alternative).alias("p"),
        *_bounds(diff, F.lit(stats.z_quantile(level)) * spread, alternative),
    ]


def ztest(
    df: DataFrame,
    group: str,
    flag: str,
    a: object,
    b: object,
    alternative: str = "two-sided",
    alpha: float = 0.05,
    user: str | None = None,
) -> DataFrame:
    """Difference of conversions b - a: pooled z for the test, unpooled interval.

    -> n_a, n_b, rate_a, rate_b, diff, z, p, ci_lo, ci_hi.
    """
    stats.check_alternative(alternative)
    rows = one_row_per_user(df, user, group, [flag]) if user else df
    sides = _sides(rows, group, [flag], a, b)
    return sides.select(
        "n_a",
        "n_b",
        F.col("mean_a").alias("rate_a"),
        F.col("mean_b").alias("rate_b"),
        *_ztest_columns(alternative, alpha),
    )


def ab_report(
    df: DataFrame,
    group: str,
    metrics: dict[str, str],
    a: object,
    b: object,
    alternative: str = "two-sided",
    alpha: float = 0.05,
    user: str | None = None,
) -> DataFrame:
    """All metrics of a test side by side, from one pass over the users.

    -> metric, kind, n_a, n_b, value_a, value_b, diff, stat, p, ci_lo, ci_hi, lift, significant.
    `metrics` maps a column to `mean` (Welch's t) or `rate` (pooled z). Lift is relative to group a.
    """
    stats.check_alternative(alternative)
    unknown = set(metrics.values()) - {"mean", "rate"}
    if unknown:
        raise ValueError(f"kind must be mean or rate, got {sorted(unknown)}")
    rows = one_row_per_user(df, user, group, list(metrics)) if user else df
    sides = _sides(rows, group, list(metrics), a, b)
    shared = ["metric", "n_a", "n_b", F.col("mean_a").alias("value_a"), F.col("mean_b").alias("value_b")]
    parts = []
    for kind, test, stat in (("mean", _welch_columns, "t"), ("rate", _ztest_columns, "z")):
        chosen = [m for m, k in metrics.items() if k == kind]
        if chosen:
            tested = sides.where(F.col("metric").isin(chosen)).select(*shared, *test(alternative, alpha))
            parts.append(tested.withColumn("kind", F.lit(kind)).withColumn("stat", F.col(stat)))
    columns = ["metric", "kind", "n_a", "n_b", "value_a", "value_b", "diff", "stat", "p", "ci_lo", "ci_hi"]
    out = parts[0].select(columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(columns))
    return out.withColumn("lift", ratio(F.col("diff"), F.col("value_a"))).withColumn(
        "significant", F.coalesce(F.col("p") < F.lit(alpha), F.lit(False))
    )
