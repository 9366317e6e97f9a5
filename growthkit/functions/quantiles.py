"""Distribution of a value per group, with exact quantiles, without gathering or shuffling a group's values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthkit.functions.columns import attach, join_groups, names

#: Ranks of a sketch are right to one in ACCURACY of a group; a bracket around a wanted rank reaches MARGIN such errors
#: to each side.
ACCURACY, MARGIN = 10000, 3
MOMENTS = ["n_rows", "n", "mean", "sd"]


def distribution(
    df: DataFrame,
    col: str,
    probs: dict[str, float],
    by: str | Sequence[str] = (),
    exact: bool = True,
    accuracy: int = ACCURACY,
    typed: bool = False,
) -> DataFrame:
    """One row per group -> by, n_rows, n, mean, sd, and an interpolated quantile per name in `probs`.

    `n` counts known values; NULL and NaN are unknown. With `exact=False` quantiles come from the
    sketch of `percentile_approx`: one small state per group and task, one shuffle.

    The exact form takes the same sketch for a first look: it gives two split points around each wanted rank, a
    few ten thousandths of the group apart, whatever the distribution. A second pass counts the values below, between and above
    the split points exactly, and only those inside a bracket are told apart, after they are counted; the rank is looked up among
    these. So a group with a third of all rows leaves its tasks as counts, a value with a third of all rows as one, and a
    lookup sees some 6 in 10,000 of a group's values for each quantile (a larger `accuracy` means fewer). Groups no larger than
    `accuracy` are one bracket. Split points only decide how much is looked up: were a sketch worse than it promises, or its points
    lost and made anew in between, the query would fail and not be wrong.

    Values keep their type until they are interpolated, so that whole numbers and decimals are compared exactly; `typed` quantiles
    keep it, rounded half up to its scale.
    """
    by = names(by)
    kind = df.schema[col].dataType
    real = not isinstance(kind, (T.IntegralType, T.DecimalType))
    value = F.col(col).cast("double") if real else F.col(col)
    known = F.when(~F.isnan(value), value) if real else value
    # A struct is never NULL itself, and structs with NULL fields are equal to each other.
    key = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(1).alias("__all"))
    rows = df.select(key.alias("__g"), known.alias("__v"), known.cast("double").alias("__d"))
    moments = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count("__v").alias("n"),
        F.avg("__d").alias("mean"),
        F.stddev_samp("__d").alias("sd"),
    ]
    if not exact:
        sketched = [F.percentile_approx("__d", float(p), accuracy).alias(n) for n, p in probs.items()]
        return _unpack(rows.groupBy("__g").agg(*moments, *sketched), by, probs)

    # Split points in order of their ranks, and for each probability the first and last of its bracket.
    reach = MARGIN / accuracy
    ends = {n: (max(0.0, float(p) - reach), min(1.0, float(p) + reach)) for n, p in probs.items()}
    points = sorted({x for pair in ends.values() for x in pair})
    brackets = sorted({(points.index(lo), points.index(hi)) for lo, hi in ends.values()})
    look = rows.groupBy("__g").agg(*moments, F.percentile_approx("__d", points, accuracy).alias("__s"))
    splits = look.select("__g", F.struct("__s", (F.col("n") <= accuracy).alias("whole")).alias("__look"))
    if by:
        placed = attach(rows.where("__v IS NOT NULL"), splits, ["__g"])
    else:
        placed = rows.where("__v IS NOT NULL").withColumn("__look", splits.select("__look").scalar())

    # Twice the number of points passed, less one on a point itself: even codes are open intervals, odd ones points. Codes
    # between two equal points are that point.
    passed = " + ".join(f"CAST(__d >= __look.__s[{i}] AS INT) + CAST(__d > __look.__s[{i}] AS INT)" for i in range(len(points)))
    inside = " OR ".join(f"__code BETWEEN {2 * lo + 1} AND {2 * hi + 1}" for lo, hi in brackets)
    between = "get(__look.__s, CAST(__code div 2 AS INT) - 1) = get(__look.__s, CAST(__code div 2 AS INT))"
    placed = placed.withColumn("__code", F.expr(f"CASE WHEN __look.whole THEN 0 ELSE {passed} END"))
    apart = F.expr(f"__look.whole OR __code % 2 = 1 OR {inside} OR coalesce({between}, false)")
    counts = placed.select("__g", "__v", "__code", F.when(apart, F.col("__v")).alias("__x"))
    counts = counts.groupBy("__g", "__code", "__x").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")
    )

    # Counts in order of their values, which must not overlap.
    along = W.partitionBy("__g").orderBy("__lo", "__hi").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy("__g").orderBy("__lo", "__hi").rowsBetween(W.unboundedPreceding, -1)
    ranked = counts.withColumns(
        {
            "__first": F.sum("__n").over(along) - F.col("__n"),
            "__total": F.sum("__n").over(W.partitionBy("__g")),
            "__past": F.max("__hi").over(before),
        }
    )
    # Elsewhere values are only counted; a rank falls there only on a value that fills its interval.
    sound = F.coalesce(F.col("__past") < F.col("__lo"), F.lit(True))
    picked_value = (
        F.when(sound & F.col("__x").isNotNull(), F.col("__x"))
        .when(sound & (F.col("__lo") == F.col("__hi")), F.col("__lo"))
        .otherwise(F.raise_error(F.lit("split points do not fit the values")).cast(rows.schema["__v"].dataType))
    )
    position = {n: F.expr(f"{float(p)!r}D * (__total - 1)") for n, p in probs.items()}

    def value_at(rank: Column) -> Column:
        rank = rank.cast("bigint")
        return F.max(F.when((rank >= F.col("__first")) & (rank < F.col("__first") + F.col("__n")), picked_value))

    picked = ranked.groupBy("__g").agg(
        F.max("__total").alias("__total"),
        *[value_at(F.floor(at)).alias(f"__low_{n}") for n, at in position.items()],
        *[value_at(F.ceil(at)).alias(f"__high_{n}") for n, at in position.items()],
    )

    def interpolated(n: str, at: Column) -> Column:
        low, high, share = F.col(f"__low_{n}"), F.col(f"__high_{n}"), at - F.floor(at)
        if real or not typed:
            low, high = low.cast("double"), high.cast("double")
            return low + (high - low) * share
        scale = kind.scale if isinstance(kind, T.DecimalType) else 0
        gap = high.cast("decimal(38,6)") - low.cast("decimal(38,6)")
        part = F.round(gap * share.cast("decimal(7,6)"), scale)
        return (low.cast(f"decimal(38,{scale})") + part.cast(f"decimal(38,{scale})")).cast(kind)

    points_of = [interpolated(n, at).alias(n) for n, at in position.items()]
    look = look.select("__g", *MOMENTS)
    if by:
        return _unpack(join_groups(look, picked.select("__g", *points_of), ["__g"]), by, probs)
    one = look.withColumn("__q", picked.select(F.struct(*points_of)).scalar())
    return one.select(*MOMENTS, *[F.col("__q")[n].alias(n) for n in probs])


def _unpack(out: DataFrame, by: Sequence[str], probs: dict[str, float]) -> DataFrame:
    return out.select(*[F.col("__g")[c].alias(c) for c in by], *MOMENTS, *probs)


def quantiles(
    df: DataFrame,
    col: str,
    probs: dict[str, float],
    by: str | Sequence[str] = (),
    exact: bool = True,
    accuracy: int = ACCURACY,
    typed: bool = False,
) -> DataFrame:
    """Interpolated quantiles of `col` per group -> by, one column per name. See `distribution`."""
    return distribution(df, col, probs, by, exact, accuracy, typed).drop(*MOMENTS)
