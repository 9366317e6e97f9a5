"""Customer segments: RFM scores and K-Means."""

from __future__ import annotations

import datetime as dt
import math
import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import add

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from growthkit.functions.columns import names, ratio, to_long
from growthkit.functions.quantiles import quantiles


def rfm(
    orders: DataFrame, user: str, ts: str, amount: str, as_of: dt.date, bins: int = 5, exact: bool = True
) -> DataFrame:
    """Recency, frequency, monetary value and scores 1..bins per user.

    -> user, r_days, freq, monetary, r, f, m. Orders up to and including `as_of` count. Thresholds
    are interpolated percentiles over users, so equal values share a score; a recent
    last order gives a high `r`.
    """
    per_user = (
        orders.where((F.col(ts) < F.lit(as_of + dt.timedelta(days=1))) & F.col(user).isNotNull())
        .groupBy(user)
        .agg(
            F.datediff(F.lit(as_of), F.max(F.to_date(ts))).cast("bigint").alias("r_days"),
            F.count(F.lit(1)).alias("freq"),
            F.sum(amount).cast("double").alias("monetary"),
        )
    )
    cuts = {f"q{i}": i / bins for i in range(1, bins)}
    measures = ["r_days", "freq", "monetary"]
    long = to_long(per_user, [], measures, "k", "v")
    # Three rows of thresholds, folded into one scalar value that the plan names once.
    edges = quantiles(long, "v", cuts, "k", exact).agg(
        F.map_from_entries(F.collect_list(F.struct("k", F.array(*cuts)))).alias("e")
    ).scalar()

    def above(col: str) -> Column:
        return F.size(F.filter(F.element_at("__edges", F.lit(col)), lambda edge: edge < F.col(col))).cast("bigint")

    scores = {"r": F.lit(bins).cast("bigint") - above("r_days"), "f": above("freq") + 1, "m": above("monetary") + 1}
    return per_user.withColumn("__edges", edges).withColumns(scores).drop("__edges")


def rfm_summary(scores: DataFrame) -> DataFrame:
    """RFM cells -> r, f, m, customers, revenue, customer_share, revenue_share."""
    cells = scores.groupBy("r", "f", "m").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary").alias("revenue")
    )
    whole = W.partitionBy()
    return cells.withColumns(
        {
            "customer_share": ratio(F.col("customers"), F.sum("customers").over(whole)),
            "revenue_share": ratio(F.col("revenue"), F.sum("revenue").over(whole)),
        }
    )


def rfm_segments(scores: DataFrame, bins: int = 5) -> DataFrame:
    """`rfm` scores with `segment`, one name for each row by the first rule that fits.

    high means a score among the upper two fifths, low among the lower two: `champions` are high in all
    three; `loyal` are high in recency and frequency; `big spenders` high in recency and money; `new` are high in
    recency and low in frequency; `at risk` are low in recency and high in frequency or money; `lost` are low
    in recency and frequency; all others are `regular`.
    """
    high = {c: F.col(c) * 5 > 3 * bins for c in "rfm"}
    low = {c: F.col(c) * 5 <= 2 * bins for c in "rfm"}
    name = (
        F.when(high["r"] & high["f"] & high["m"], "champions")
        .when(high["r"] & high["f"], "loyal")
        .when(high["r"] & high["m"], "big spenders")
        .when(high["r"] & low["f"], "new")
        .when(low["r"] & (high["f"] | high["m"]), "at risk")
        .when(low["r"] & low["f"], "lost")
        .otherwise("regular")
    )
    return scores.withColumn("segment", name)


Centres = list[tuple[float, ...]]


def _known(features: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in features))


@contextmanager
def _scaled(
    df: DataFrame, ident: str, features: Sequence[str], scale: bool
) -> Iterator[tuple[dict[str, Column], DataFrame]]:
    """(features of mean 0 and sample deviation 1 as expressions over the input, complete rows with them).

    The rows are kept for the passes of a fit. A constant feature becomes 0.
    """
    rows = df.select(ident, *[F.col(c).cast("double").alias(c) for c in features])
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shape = {c: F.col(c).cast("double") for c in features}
        if scale:
            complete = kept.where(_known(features))
            stats = complete.agg(
                *[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_samp(c).alias(f"s_{c}") for c in features]
            ).first()
            for c in features:
                centred = F.col(c).cast("double") - F.lit(stats[f"m_{c}"])
                sd = stats[f"s_{c}"]
                shape[c] = centred / F.lit(sd) if sd else F.when(F.col(c).isNotNull(), F.lit(0.0))
        yield shape, kept.withColumns(shape).where(_known(features))
    finally:
        kept.unpersist()


def _nearest(features: Sequence[str]) -> str:
    """SQL text of an array, for each model of `_with_models` struct(model, near): its label, and struct(dist, cluster)
    of its closest centre; a tie goes to the lower number.

    The text depends on the features alone. A centre is not measured once the closest so far lies within half of that
    one's distance to any other: by the triangle inequality none can be closer.
    """
    width = len(features)

    def measured(i: str) -> str:
        gaps = [f"(`{c}` - get(__centres, {i} * {width} + {j}))" for j, c in enumerate(features)]
        return f"named_struct('dist', {' + '.join(f'{gap} * {gap}' for gap in gaps)}, 'centre', {i})"

    first = "get(__start, __m)"
    closer = f"IF(4 * __best.dist < get(__apart, __best.centre), __best, least(__best, {measured('__i')}))"
    found = f"named_struct('dist', __best.dist, 'cluster', __best.centre - {first})"
    near = (
        f"aggregate(sequence({first}, {first} + get(__size, __m) - 1), {measured(first)},"
        f" (__best, __i) -> {closer}, __best -> {found})"
    )
    return (
        "transform(sequence(0, size(__label) - 1), __m -> "
        f"named_struct('model', get(__label, __m), 'near', {near}))"
    )


def _with_models(points: DataFrame, models: Sequence[Centres], labels: Sequence[int]) -> DataFrame:
    """`points` with all centres of all models as array literals."""
    sizes = [len(centres) for centres in models]
    arrays = {
        "__centres": np.array([x for centres in models for centre in centres for x in centre], float),
        "__apart": np.concatenate([_apart(centres) for centres in models]),
        "__start": np.cumsum([0, *sizes[:-1]]),
        "__size": np.array(sizes),
        "__label": np.array(labels),
    }
    return points.withColumns({name: F.lit(values) for name, values in arrays.items()})


def _apart(centres: Centres) -> np.ndarray:
    """For each centre the squared distance to the closest other one."""
    points = np.array(centres, float)
    out = np.full(len(points), np.inf)
    for i, point in enumerate(points):
        gaps = ((points - point) ** 2).sum(axis=1)
        gaps[i] = np.inf
        out[i] = gaps.min()
    return out


def _labelled(points: DataFrame, features: Sequence[str], centres: Centres, kept: Sequence[str]) -> DataFrame:
    """The columns `kept` and cluster, NULL where a feature is unknown."""
    cluster = F.when(_known(features), F.expr(f"{_nearest(features)}[0].near.cluster"))
    return _with_models(points, [centres], [0]).select(*kept, cluster.alias("cluster"))


def _starts(
    points: DataFrame, ident: str, features: Sequence[str], k: int, seeds: Sequence[int]
) -> dict[int, Centres]:
    """For each seed k distinct points, chosen by a hash of seed and id, so not by partitioning.

    The choice for a smaller k is the beginning of the one for a larger k.
    """
    first = []
    for seed in seeds:
        pick = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col(ident).cast("string")))
        places = points.groupBy(*features).agg(F.min(pick).alias("pick"))
        first.append(places.orderBy("pick").limit(k).withColumn("seed", F.lit(seed)))
    rows = sorted(reduce(DataFrame.unionByName, first).collect(), key=lambda r: r["pick"])
    starts = {seed: [tuple(r[c] for c in features) for r in rows if r["seed"] == seed] for seed in seeds}
    for start in starts.values():
        if len(start) < k:
            raise ValueError(f"k={k} exceeds the number of distinct points ({len(start)})")
    return starts


def _fit(
    points: DataFrame, features: Sequence[str], starts: list[Centres], max_iter: int, tol: float
) -> list[tuple[Centres, float]]:
    """(centres, cost) of `_lloyd` for each start."""
    return [(centres, cost) for centres, cost, _ in _lloyd(points, features, starts, max_iter, tol)]


def _lloyd(
    points: DataFrame, features: Sequence[str], starts: list[Centres], max_iter: int, tol: float
) -> list[tuple[Centres, float, bool]]:
    """Lloyd's iterations for several starts at once -> (centres, cost, converged) for each.

    One pass over the points serves all starts; only sums per cluster come back to the driver. The cost is that
    of the centres returned: a start that still moves after `max_iter` passes is scored in one more.
    """
    models = [list(start) for start in starts]
    costs = [math.inf] * len(models)
    moving = list(range(len(models)))
    sums_of = [F.sum("__at.near.dist").alias("cost"), *[F.avg(c).alias(f"c_{c}") for c in features]]
    for turn in range(max_iter + 1):
        sums = (
            _with_models(points, [models[m] for m in moving], moving)
            .select(*features, F.expr(f"explode({_nearest(features)}) AS __at"))
            .groupBy("__at.model", "__at.near.cluster")
            .agg(*sums_of)
            .collect()
        )
        still = []
        for m in moving:
            rows = [row for row in sums if row["model"] == m]
            costs[m] = sum(row["cost"] for row in rows)
            if turn == max_iter:
                continue
            moved = list(models[m])
            for row in rows:
                moved[row["cluster"]] = tuple(row[f"c_{c}"] for c in features)
            if max(math.dist(old, new) for old, new in zip(models[m], moved)) > tol:
                still.append(m)
            models[m] = moved
        if turn < max_iter:
            moving = still
        if not moving:
            break
    return [(model, cost, m not in moving) for m, (model, cost) in enumerate(zip(models, costs))]


def _seed_list(seeds: int | Sequence[int]) -> list[int]:
    return [seeds] if isinstance(seeds, int) else list(seeds)


def kmeans(
    df: DataFrame,
    ident: str,
    features: str | Sequence[str],
    k: int,
    seeds: int | Sequence[int] = (1, 2, 3),
    scale: bool = True,
    max_iter: int = 100,
    tol: float = 1e-4,
    with_input: bool = False,
) -> DataFrame:
    """Cluster number per row -> ident, cluster; with `with_input` all columns of `df` and cluster. Runs Spark jobs when called.

    Starting points depend on ids and seeds alone, which makes the result independent of
    partitioning; the start with the lowest cost wins and clusters are numbered by
    their centres. Rows with an unknown feature get a NULL cluster. A best start that still moved after
    `max_iter` passes is warned of.
    """
    features = names(features)
    with _scaled(df, ident, features, scale) as (shape, points):
        starts = _starts(points, ident, features, k, _seed_list(seeds))
        fits = _lloyd(points, features, list(starts.values()), max_iter, tol)
        centres, _, converged = min(fits, key=lambda fit: fit[1])
    if not converged:
        warnings.warn(f"no convergence after {max_iter} passes", RuntimeWarning, stacklevel=2)
    kept = df.columns if with_input else [ident]
    placed = {f"__f{i}": shape[c] for i, c in enumerate(features)}
    return _labelled(df.withColumns(placed), list(placed), sorted(centres), kept)


def choose_k(
    df: DataFrame,
    ident: str,
    features: str | Sequence[str],
    ks: Sequence[int],
    seeds: int | Sequence[int] = (1, 2, 3),
    scale: bool = True,
    max_iter: int = 100,
    tol: float = 1e-4,
) -> DataFrame:
    """Cost and silhouette for several k -> k, cost, silhouette, converged. Runs Spark jobs when called."""
    features, seeds = names(features), _seed_list(seeds)
    evaluator = ClusteringEvaluator(featuresCol="__v", predictionCol="cluster")
    vectors = VectorAssembler(inputCols=features, outputCol="__v")
    lines = []
    with _scaled(df, ident, features, scale) as (_, points):
        starts = _starts(points, ident, features, max(ks), seeds)
        wanted = [(k, seed) for k in ks for seed in seeds]
        fits = _lloyd(points, features, [starts[seed][:k] for k, seed in wanted], max_iter, tol)
        for k in ks:
            centres, cost, converged = min((fit for (kk, _), fit in zip(wanted, fits) if kk == k), key=lambda fit: fit[1])
            labelled = _labelled(points, features, centres, features).withColumn("cluster", F.col("cluster").cast("int"))
            silhouette = evaluator.evaluate(vectors.transform(labelled)) if k > 1 else None
            lines.append((k, cost, silhouette, converged))
    return df.sparkSession.createDataFrame(lines, "k bigint, cost double, silhouette double, converged boolean")


def cluster_profile(df: DataFrame, cluster: str, features: str | Sequence[str]) -> DataFrame:
    """Size and feature means per cluster -> cluster, n, <feature> means."""
    return df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in names(features)]
    )
