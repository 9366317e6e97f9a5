"""Exploratory aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthkit.functions.columns import known_number, names, period_of, ratio, salts_of, to_long, with_share
from growthkit.functions.quantiles import distribution


def group_share(df: DataFrame, dims: str | Sequence[str], within: str | Sequence[str] | None = None) -> DataFrame:
    """Rows per category and their share -> dims, n, share."""
    counted = df.groupBy(*names(dims)).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counted, "n", names(within))


def market_share(
    df: DataFrame, entity: str | Sequence[str], amount: str, within: str | Sequence[str] | None = None
) -> DataFrame:
    """Amount per player and its share of the whole -> entity, amount, share. NULL and NaN amounts are unknown and add nothing."""
    summed = df.groupBy(*names(entity)).agg(F.sum(known_number(df, amount)).alias("amount"))
    return with_share(summed, "amount", names(within))


def summarize(df: DataFrame, dims: str | Sequence[str], col: str, exact: bool = True) -> DataFrame:
    """Distribution per group -> dims, n, mean, sd, median, p05, p95. `n` counts known values."""
    dims = names(dims)
    points = distribution(df, col, {"median": 0.5, "p05": 0.05, "p95": 0.95}, dims, exact)
    return points.select(*dims, "n", "mean", "sd", "median", "p05", "p95")


def avg_members(df: DataFrame, container: str | Sequence[str], member: str) -> DataFrame:
    """Mean number of distinct members per container -> containers, avg_members.

    Rows without a container are left out.
    """
    container = names(container)
    pairs = df.select(*container, member).dropna(subset=container).distinct()
    return (
        pairs.groupBy(*container)
        .agg(F.count(member).alias("members"))
        .agg(F.count(F.lit(1)).alias("containers"), F.avg("members").alias("avg_members"))
    )


def reaction(df: DataFrame, dim: str | Sequence[str], score: str) -> DataFrame:
    """Mean score per topic and how many rows carry one -> dim, n, n_scored, coverage, avg_score."""
    return (
        df.groupBy(*names(dim))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(score).alias("n_scored"),
            F.avg(score).alias("avg_score"),
        )
        .withColumn("coverage", ratio(F.col("n_scored"), F.col("n")))
    )


def top_k(
    df: DataFrame,
    metric: str,
    k: int,
    by: str | Sequence[str] | None = None,
    tie: str | Sequence[str] = (),
    one_task: int = 10_000,
) -> DataFrame:
    """The k rows with the highest metric, overall or per group, with their place in `rank`.

    `tie` decides between equal values and should make the order total. A NULL or NaN metric is unknown and comes last. Per group,
    each of many parts of it (by row content) gives its k best rows, and the k best of those are the result, for any k.

    Overall, up to `one_task` rows are brought to one task. For a larger k the rows are cut into ranges of the metric, and equal
    values into ranges of a numeric first tie column; ranges are counted, ranked inside, and the rows of the ranges before are
    added. The split points are taken from a sketch when this is called, in a Spark job; only they reach the driver.
    """
    ties = names(tie)
    value = known_number(df, metric)
    order = [value.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
    by = names(by)
    if by:
        content = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
        part = F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.lit(salts_of(df)))
        within_part = F.row_number().over(W.partitionBy(*by, "__part").orderBy(*order))
        df = df.withColumn("__part", part).withColumn("__at", within_part)
        df = df.where(F.col("__at") <= k).drop("__part", "__at")
        place = F.row_number().over(W.partitionBy(*by).orderBy(*order))
        return df.withColumn("rank", place.cast("bigint")).where(F.col("rank") <= k)
    if k > one_task and isinstance(df.schema[metric].dataType, T.NumericType):
        return _ranked(df, value, k, order, ties)
    # Only k rows reach the window.
    best = df.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(W.orderBy(*order)).cast("bigint"))


#: Ranges of a metric that `top_k` ranks apart, and of the tie column inside a value that fills one.
RANGES, TIE_RANGES = 1024, 64


def _ranked(df: DataFrame, value: Column, k: int, order: list[Column], ties: list[str]) -> DataFrame:
    numeric = bool(ties) and isinstance(df.schema[ties[0]].dataType, T.NumericType)
    looks = {"m": (value, RANGES), "t": (known_number(df, ties[0]), TIE_RANGES)} if numeric else {"m": (value, RANGES)}
    sketch = df.agg(
        *[
            F.percentile_approx(column.cast("double"), [i / n for i in range(1, n)], 10 * n).alias(name)
            for name, (column, n) in looks.items()
        ]
    ).first()

    def range_of(column: Column, points: list[float] | None) -> Column:
        """Even numbers between the points, odd ones on a point; unknown values after all."""
        points = sorted(set(points or []))
        # rows of 32 points are looked through, then points of one row
        places, rows = (
            F.expr(f"CAST(array({', '.join(f'{str(float(p))!r}' for p in some)}) AS array<double>)") for some in (points, points[::32])
        )
        at = column.cast("double")
        row = F.greatest(F.size(F.filter(rows, lambda p: p <= at)) - 1, F.lit(0))
        near = F.slice(places, row * 32 + 1, 32)
        below, equal = F.size(F.filter(near, lambda p: p <= at)), F.array_contains(near, at)
        code = 2 * (row * 32 + below) - F.when(equal, 1).otherwise(0)
        return F.when(at.isNotNull(), code).otherwise(F.lit(2 * len(points) + 1))

    code = F.when(value.isNotNull(), -range_of(value, sketch["m"])).otherwise(F.lit(1))
    inside = F.lit(0)
    if numeric:
        inside = F.when(F.col("__m").isNotNull() & (F.pmod("__m", F.lit(2)) == 1), range_of(looks["t"][0], sketch["t"])).otherwise(F.lit(0))
    placed = df.withColumn("__m", code).withColumn("__t", inside)
    # At most 2 * RANGES * TIE_RANGES rows of counts are ordered in one task.
    sizes = placed.groupBy("__m", "__t").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.orderBy("__m", "__t").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__n")
    sizes = sizes.withColumn("__before", before).where(F.col("__before") < k).select("__m", "__t", "__before")
    within = F.row_number().over(W.partitionBy("__m", "__t").orderBy(*order))
    ranked = placed.join(sizes, ["__m", "__t"]).withColumn("rank", F.col("__before") + within).where(F.col("rank") <= k)
    return ranked.select(*df.columns, "rank")


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str], other: str = "other") -> DataFrame:
    """Counts of row category by column category -> row, one column for each of `values`, other.

    Rows whose column category is not listed, or unknown, are counted in `other`.
    """
    listed = F.coalesce(F.col(col).isin(list(values)), F.lit(False))
    return df.groupBy(row).agg(
        *[F.count_if(F.col(col) == v).alias(v) for v in values], F.count_if(~listed).alias(other)
    )


def outcome_by(df: DataFrame, trait: str | Sequence[str], outcome: str) -> DataFrame:
    """How often the outcome holds per trait -> trait, n, n_pos, rate."""
    return (
        df.groupBy(*names(trait))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(outcome)).alias("n_pos"))
        .withColumn("rate", ratio(F.col("n_pos"), F.col("n")))
    )


def corr(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation over rows where both are known -> n, corr."""
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return known.agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("corr"))


def purchase_activity(
    purchases: DataFrame,
    user: str,
    amount: str,
    users: DataFrame | None = None,
    dims: str | Sequence[str] | None = None,
) -> DataFrame:
    """How buyers buy, per dim -> dims, buyers, orders, orders_per_buyer, avg_amount, amount_per_buyer.

    Purchases are reduced to one row per buyer before the user table (with `dims`) is joined.
    Purchases without a user are left out.
    """
    dims = names(dims)
    own = [d for d in dims if users is None]
    known = purchases.where(F.col(user).isNotNull())
    per_user = known.groupBy(user, *own).agg(F.count(F.lit(1)).alias("orders"), F.sum(amount).alias("amount"))
    if users is not None:
        per_user = per_user.join(users.select(user, *dims), user, "left")
    return (
        per_user.groupBy(*dims)
        .agg(
            F.count(F.lit(1)).alias("buyers"),
            F.sum("orders").alias("orders"),
            F.sum("amount").alias("amount"),
        )
        .select(
            *dims,
            "buyers",
            "orders",
            ratio(F.col("orders"), F.col("buyers")).alias("orders_per_buyer"),
            ratio(F.col("amount"), F.col("orders")).alias("avg_amount"),
            ratio(F.col("amount"), F.col("buyers")).alias("amount_per_buyer"),
        )
    )


def compare_groups(df: DataFrame, group: str, cols: str | Sequence[str], exact: bool = True) -> DataFrame:
    """Several metrics side by side for groups -> metric, group, n, mean, median."""
    cols = names(cols)
    long = to_long(df.select(F.col(group).alias("group"), *cols), ["group"], cols, "metric", "value")
    return distribution(long, "value", {"median": 0.5}, ["metric", "group"], exact).drop("n_rows", "sd")


def plan_value(
    df: DataFrame, user: str, plan: str, ts: str, revenue: str, users: DataFrame | None = None
) -> DataFrame:
    """Revenue per user and month by plan -> plan, month, users, revenue, per_user.

    `plan` is a column of `df`, or of `users` when the plan is a user attribute. Rows without a user or a time are
    left out: nobody's plan earned them.
    """
    df = df.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    own = [F.col(plan).alias("plan")] if users is None else []
    rows = df.select(F.col(user).alias("user"), *own, period_of(ts, "month").alias("month"), F.col(revenue).alias("r"))
    per_user = rows.groupBy("user", "month", *(["plan"] if own else [])).agg(F.sum("r").alias("r"))
    if users is not None:
        per_user = per_user.join(users.select(F.col(user).alias("user"), F.col(plan).alias("plan")), "user", "left")
    return (
        per_user.groupBy("plan", "month")
        .agg(F.count("user").alias("users"), F.sum("r").alias("revenue"))
        .withColumn("per_user", ratio(F.col("revenue"), F.col("users")))
    )


def time_budget(
    df: DataFrame, container: str | Sequence[str], seconds: str, day: str | None = None
) -> DataFrame:
    """Time used per event (and day) -> container, day, n, total, mean, longest."""
    keys = [F.col(c) for c in names(container)]
    if day:
        keys.append(F.to_date(day).alias("day"))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(seconds).alias("total"),
        F.avg(seconds).alias("mean"),
        F.max(seconds).alias("longest"),
    )
