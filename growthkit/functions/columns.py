"""Column expressions and join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The period names an operator accepts.
PERIODS = ("day", "week", "month", "quarter", "year")


def names(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def tidy(col: Column, digits: int = 4) -> Column:
    """Round with ties nudged up, so that engines agree on values that sit on a tie."""
    return F.round(col + F.lit(1e-9), digits)


def period_of(ts: str | Column, period: str) -> Column:
    """First day of the period that holds `ts`, as a date."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, got {period!r}")
    day = F.to_date(ts)
    return day if period == "day" else F.trunc(day, period).cast("date")


def period_end(start: Column, period: str) -> Column:
    """First day of the period after the one that begins at `start`."""
    months = {"month": 1, "quarter": 3, "year": 12}
    if period in months:
        return F.add_months(start, months[period])
    return F.date_add(start, {"day": 1, "week": 7}[period])


def period_age(start: Column, end: Column, period: str) -> Column:
    """Whole periods between two period starts."""
    months = (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))
    days = F.datediff(end, start)
    age = {
        "day": days,
        "week": F.floor(days / 7),
        "month": months,
        "quarter": F.floor(months / 3),
        "year": F.year(end) - F.year(start),
    }[period]
    return age.cast("bigint")


def to_long(df: DataFrame, keep: Sequence[str], cols: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per row and column of `cols`, values as double.

    Unlike `unpivot` this lets Spark recognise two uses of the result as the same exchange.
    """
    cells = [F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols]
    return df.select(*keep, F.inline(F.array(*cells)))


def join_groups(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join on group columns in which NULL counts as a group of its own."""
    renamed = right.select(
        *[F.col(c).alias(f"__{c}") for c in on],
        *[F.col(c) for c in right.columns if c not in on],
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on])
    return left.join(renamed, same, how).drop(*[f"__{c}" for c in on])


def salts_of(df: DataFrame) -> int:
    """Parts of a hot group: as many as the session has shuffle partitions, so that they fill the cluster."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def attach(big: DataFrame, per_group: DataFrame, on: Sequence[str], salts: int | None = None) -> DataFrame:
    """Left join row-level data with one row per group, when one group may be huge.

    The group rows are repeated once per salt and every big row takes one salt from
    its content and its input partition (copies of one row included), so a hot group is
    spread over `salts` tasks (by default `salts_of`); a rerun task gives the same salts. Adaptive execution
    still turns this into a broadcast when the measured size of the group side is small.
    """
    salts = salts or salts_of(big)
    salted = per_group.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    content = [f.name for f in big.schema if not isinstance(f.dataType, T.MapType)]
    salt = F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.lit(salts))
    spread = big.withColumn("__salt", salt.cast("int"))
    return join_groups(spread, salted, [*on, "__salt"]).drop("__salt")


def with_share(df: DataFrame, value: str, within: Sequence[str] = (), name: str = "share") -> DataFrame:
    """Add each row's share of the sum of `value`, overall or within groups.

    Totals are aggregated, not windowed, so the number of rows sharing a total does not matter.
    """
    if not within:
        total = df.agg(F.sum(value)).scalar()
        return df.withColumn(name, ratio(F.col(value), total))
    totals = df.groupBy(*within).agg(F.sum(value).alias("__total"))
    return attach(df, totals, within).withColumn(name, ratio(F.col(value), F.col("__total"))).drop("__total")


def known_number(df: DataFrame, col: str) -> Column:
    """The column with NaN as NULL; whole numbers and decimals keep their type."""
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), F.col(col))
    return F.col(col)


def exact_sum(df: DataFrame, col: str, of: Column | None = None) -> Column:
    """The sum of a column (or of `of`, made from it), 0 without known values; whole numbers and decimals are added up exactly."""
    kind = df.schema[col].dataType
    total = F.sum(F.col(col) if of is None else of)
    if isinstance(kind, T.DecimalType):
        return F.coalesce(total, F.lit(0).cast(f"decimal({min(38, kind.precision + 10)},{kind.scale})"))
    if isinstance(kind, T.IntegralType):
        return F.coalesce(total, F.lit(0).cast("bigint"))
    return F.coalesce(total.cast("double"), F.lit(0.0))
