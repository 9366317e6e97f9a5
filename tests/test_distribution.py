"""Exact quantiles, moments, and neighbours against plain numpy and plain windows."""

from __future__ import annotations

import datetime as dt
import decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthkit.functions.ordering import with_neighbour
from growthkit.functions.quantiles import distribution, quantiles

PROBS = {"p01": 0.01, "q1": 0.25, "med": 0.5, "p99": 0.99, "low": 0.0, "top": 1.0}


def samples():
    rng = np.random.default_rng(7)
    return {
        "normal": rng.normal(0, 1, 501),
        "money": np.round(rng.lognormal(6, 3, 700), 2),
        "ties": rng.integers(0, 4, 400).astype(float),
        "narrow": 1e9 + rng.uniform(0, 1e-3, 300),
        "negative": -rng.exponential(1e5, 333),
        "one": np.array([42.0]),
        "two": np.array([-1.0, 1.0]),
    }


def test_matches_numpy(spark):
    data = samples()
    pdf = pd.concat([pd.DataFrame({"g": g, "x": x}) for g, x in data.items()])
    df = spark.createDataFrame(pdf).repartition(5)
    got = {r["g"]: r for r in distribution(df, "x", PROBS, "g").collect()}
    assert set(got) == set(data)
    for g, x in data.items():
        row = got[g]
        assert (row["n_rows"], row["n"]) == (len(x), len(x))
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-12), (g, name)
        assert row["mean"] == pytest.approx(x.mean(), rel=1e-9)


def test_matches_builtin_without_groups(spark):
    df = spark.range(0, 5000).select((F.pmod(F.xxhash64("id"), F.lit(1000)) / 7).alias("x"))
    want = df.agg(F.percentile("x", 0.2), F.percentile("x", 0.9)).first()
    got = quantiles(df, "x", {"a": 0.2, "b": 0.9}).first()
    assert (got["a"], got["b"]) == pytest.approx(tuple(want))


def test_unknown_values_and_null_groups(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", None), ("a", None), ("b", float("nan")), ("b", 5.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: (r["n_rows"], r["n"], r["mean"], r["med"]) for r in distribution(df, "x", {"med": 0.5}, "g").collect()}
    assert got == {None: (3, 2, 2.0, 2.0), "a": (2, 0, None, None), "b": (2, 1, 5.0, 5.0)}


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert distribution(df, "x", {"med": 0.5}, "g").count() == 0


def test_hot_value_and_two_keys(spark):
    rows = [("a", 1, 0.0)] * 900 + [("a", 1, float(i)) for i in range(1, 101)] + [("a", None, 7.0)]
    df = spark.createDataFrame(rows, "g string, h int, x double")
    got = {(r["g"], r["h"]): (r["n"], r["med"], r["p95"]) for r in distribution(df, "x", {"med": 0.5, "p95": 0.95}, ["g", "h"]).collect()}
    want = np.quantile([x for _, h, x in rows if h == 1], 0.95)
    assert got[("a", 1)] == (1000, 0.0, pytest.approx(want))
    assert got[("a", None)] == (1, 7.0, 7.0)


def test_sketch_form_has_the_same_columns(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, x double")
    assert distribution(df, "x", PROBS, "g", exact=False).columns == distribution(df, "x", PROBS, "g").columns


@pytest.fixture(scope="module")
def visits(spark):
    """One user has a third of the rows; some times are equal."""
    rng = np.random.default_rng(3)
    n = 900
    user = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n))
    minute = rng.integers(0, 60 * 24 * 3, n)
    start = dt.datetime(2024, 3, 1)
    rows = [(i, int(u), start + dt.timedelta(minutes=int(m)), f"e{i % 5}") for i, (u, m) in enumerate(zip(user, minute))]
    return spark.createDataFrame(rows, "id bigint, user bigint, ts timestamp_ntz, kind string").cache()


@pytest.mark.parametrize("previous", [False, True])
@pytest.mark.parametrize("grain", ["hour", "day", "month"])
def test_neighbour_equals_plain_window(visits, previous, grain):
    near = with_neighbour(visits, "user", "ts", "id", ["id", "kind"], previous=previous, grain=grain)
    got = {r["id"]: r["next"] and tuple(r["next"]) for r in near.collect()}
    w = W.partitionBy("user").orderBy("ts", "id")
    step = (F.lag if previous else F.lead)(F.struct("id", "kind")).over(w)
    want = {r["id"]: r["n"] and tuple(r["n"]) for r in visits.withColumn("n", step).collect()}
    assert got == want


def test_same_result_without_broadcast_joins(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", None), ("b", 5.0), ("b", 7.0), (None, 8.0)] * 3
    df = spark.createDataFrame(rows, "g string, x double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["g"]: (r["n_rows"], r["n"], r["med"]) for r in distribution(df, "x", {"med": 0.5}, "g").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {None: (9, 9, 3.0), "a": (3, 0, None), "b": (6, 6, 6.0)}


SPREADS = {
    "rates": "id / 1e9",
    "seconds": "1700000000D + id * 2.592",
    "ids": "CAST(id + 4000000000 AS DOUBLE)",
    "log-uniform": "exp(pmod(xxhash64(id), 1000000007) / 1000000007D * 40 - 20)",
    "two clusters": "CASE WHEN id % 2 = 0 THEN id / 1e12 ELSE 1e12 + id END",
    "a hot value": "CASE WHEN id % 3 = 0 THEN 7D ELSE rand(1) * id END",
}


@pytest.mark.parametrize("name", SPREADS)
def test_values_are_exact_and_spread(spark, name):
    """Exact for a million values of any distribution, and no task that looks up a rank holds a fiftieth of them."""
    df = spark.range(0, 1_000_000, 1, 8).selectExpr("id % 2 AS g", f"{SPREADS[name]} AS v").persist()
    probs = {"low": 0.01, "q": 0.5, "high": 0.95}
    out = quantiles(df, "v", probs, "g")
    got = {r["g"]: [r[n] for n in probs] for r in out.collect()}
    want = df.groupBy("g").agg(F.percentile("v", list(probs.values())).alias("p")).collect()
    df.unpersist()
    assert set(got) == {r["g"] for r in want}
    for r in want:
        assert got[r["g"]] == pytest.approx(r["p"], rel=1e-12)
    # what is looked up are the distinct values inside the brackets
    windows = [line for line in plan_metrics(out) if line[0].startswith("Window") and "__lo" in line[1]]
    assert windows and max(rows for _, _, rows in windows) <= 20_000


def test_whole_numbers_and_decimals_are_exact(spark):
    base = 2**60
    rows = [(i % 2, base + 3 * i, f"{10**15 + i}.{i % 100:02d}") for i in range(301)]
    df = spark.createDataFrame(rows, "g int, x long, t string").withColumn("m", F.col("t").cast("decimal(20,2)"))
    for col, kind in (("x", int), ("m", decimal.Decimal)):
        got = {r["g"]: r["med"] for r in quantiles(df, col, {"med": 0.5}, "g", typed=True).collect()}
        few = {r["g"]: r["med"] for r in quantiles(df, col, {"med": 0.5}, "g", accuracy=20, typed=True).collect()}
        for g in (0, 1):
            own = sorted(kind(r[1] if col == "x" else r[2]) for r in rows if r[0] == g)
            half = len(own) // 2
            want = own[half] if len(own) % 2 else (own[half - 1] + own[half]) / decimal.Decimal(2) if col == "m" else -(-(own[half - 1] + own[half]) // 2)
            want = want if col == "x" else decimal.Decimal(want).quantize(decimal.Decimal("0.01"), decimal.ROUND_HALF_UP)
            assert got[g] == few[g] == want and isinstance(got[g], kind)


def plan_metrics(df) -> list[tuple[str, str, int]]:
    """(node, its text, the most rows that its input exchange sends) of the plan that ran."""
    found = []

    def walk(node) -> None:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name.startswith("Window"):
            found.append((name, node.simpleString(1000), rows_below(node)))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    def rows_below(node) -> int:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return rows_below(node.executedPlan())
        if name.endswith("QueryStage"):
            return rows_below(node.plan())
        if name == "ReusedExchange":
            return rows_below(node.child())
        metric = node.metrics().get("shuffleRecordsWritten")
        if metric.isDefined():
            return int(metric.get().value())
        children = node.children()
        return max((rows_below(children.apply(i)) for i in range(children.size())), default=0)

    walk(df._jdf.queryExecution().executedPlan())
    return found
