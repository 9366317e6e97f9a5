"""Segments and experiments on tiny tables."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from growthkit.operators import experiments, segments


class TestRfm:
    @pytest.fixture
    def orders(self, spark):
        data = [(u, dt.datetime(2024, 1, 1) + dt.timedelta(days=u), 10.0 * u) for u in range(1, 11)]
        data += [(10, dt.datetime(2024, 1, 2), 5.0), (None, dt.datetime(2024, 1, 2), 5.0)]
        data += [(1, dt.datetime(2025, 1, 1), 999.0)]
        return spark.createDataFrame(data, "user bigint, ts timestamp_ntz, amount double")

    def test_scores(self, orders):
        got = {r["user"]: r for r in segments.rfm(orders, "user", "ts", "amount", dt.date(2024, 1, 31)).collect()}
        assert len(got) == 10
        assert (got[1]["r_days"], got[1]["freq"], got[1]["monetary"]) == (29, 1, 10.0)
        assert [got[u]["r"] for u in range(1, 11)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
        assert [got[u]["m"] for u in range(1, 11)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
        # Equal values share a score, however many there are.
        assert [got[u]["f"] for u in (1, 5, 9, 10)] == [1, 1, 1, 5]

    def test_cells_add_up(self, orders):
        cells = segments.rfm_summary(segments.rfm(orders, "user", "ts", "amount", dt.date(2024, 1, 31)))
        got = cells.agg(F.sum("customers"), F.sum("customer_share"), F.sum("revenue_share")).first()
        assert tuple(got) == (10, pytest.approx(1), pytest.approx(1))

    def test_as_of_day_is_included(self, spark):
        df = spark.createDataFrame([(1, dt.datetime(2024, 1, 31, 23, 0), 1.0)], "user bigint, ts timestamp_ntz, amount double")
        assert segments.rfm(df, "user", "ts", "amount", dt.date(2024, 1, 31)).first()["r_days"] == 0


def slow_kmeans(points, centres, max_iter=100):
    """Lloyd's iterations in numpy."""
    for _ in range(max_iter):
        dist = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        label = dist.argmin(axis=1)
        moved = np.array([points[label == i].mean(axis=0) if (label == i).any() else c for i, c in enumerate(centres)])
        if np.abs(moved - centres).max() < 1e-9:
            break
        centres = moved
    return label, dist.min(axis=1).sum()


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    centres = [(0, 0), (10, 0), (0, 30)]
    data = []
    for i, (x, y) in enumerate(centres):
        for p in rng.normal((x, y), 0.5, (40, 2)):
            data.append((len(data), i, float(p[0]), float(p[1]), 7.0))
    return spark.createDataFrame(data, "id bigint, blob int, x double, y double, flat double")


class TestKmeans:
    @pytest.mark.parametrize("parts", [1, 4, 16])
    def test_blobs_are_found_for_any_partitioning(self, blobs, parts):
        got = segments.kmeans(blobs.repartition(parts), "id", ["x", "y", "flat"], 3)
        pairs = got.join(blobs, "id").groupBy("cluster", "blob").count().collect()
        assert sorted(r["count"] for r in pairs) == [40, 40, 40]

    def test_fit_equals_numpy(self, blobs):
        rng = np.random.default_rng(2)
        points = rng.normal(0, 1, (200, 2))
        df = blobs.sparkSession.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id bigint, x double, y double")
        start = [tuple(points[i]) for i in (3, 50, 120, 199)]
        centres, cost = segments._fit(df.repartition(3), ["x", "y"], [start], 100, 1e-9)[0]
        label, want = slow_kmeans(points, np.array(start))
        assert cost == pytest.approx(want)
        got = segments._labelled(df, ["x", "y"], centres, ["id"]).withColumnRenamed("cluster", "c").orderBy("id").collect()
        assert [r["c"] for r in got] == label.tolist()

    def test_unknown_feature_gets_no_cluster(self, spark, blobs):
        more = blobs.unionByName(spark.createDataFrame([(999, 9, None, 1.0, 7.0)], blobs.schema))
        got = segments.kmeans(more, "id", ["x", "y"], 3)
        assert got.where("id = 999").first()["cluster"] is None
        assert got.where("cluster IS NULL").count() == 1

    def test_input_columns_come_back(self, blobs):
        plain = {r["id"]: r["cluster"] for r in segments.kmeans(blobs, "id", ["x", "y"], 3).collect()}
        whole = segments.kmeans(blobs, "id", ["x", "y"], 3, with_input=True)
        assert whole.columns == [*blobs.columns, "cluster"]
        assert {r["id"]: r["cluster"] for r in whole.collect()} == plain
        assert {tuple(r)[:-1] for r in whole.collect()} == {tuple(r) for r in blobs.collect()}

    def test_too_many_clusters(self, spark):
        df = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 1.0)], "id int, x double")
        with pytest.raises(ValueError, match="distinct points"):
            segments.kmeans(df, "id", "x", 3)

    def test_nearest_of_many_centres(self, spark):
        rng = np.random.default_rng(5)
        points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.integers(-6, 7, (400, 2)))]
        models = [[(float(x), float(y)) for x, y in rng.integers(-6, 7, (k, 2))] for k in (1, 2, 40)]
        df = spark.createDataFrame(points, "id long, x double, y double")
        near = F.expr(segments._nearest(["x", "y"])).alias("near")
        got = segments._with_models(df, models, [7, 8, 9]).select("id", near).collect()
        for row in got:
            _, *at = points[row["id"]]
            for m, centres in enumerate(models):
                dist = [sum((p - q) ** 2 for p, q in zip(at, centre)) for centre in centres]
                near = row["near"][m]
                assert near["model"] == 7 + m
                assert tuple(near["near"]) == (min(dist), dist.index(min(dist)))

    def test_expression_does_not_grow_with_centres(self, spark):
        df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")

        def nodes(models):
            near = segments._with_models(df, models, range(len(models))).select(F.expr(segments._nearest(["x", "y"])))
            return near._jdf.queryExecution().optimizedPlan().expressions().apply(0).treeString().count("\n")

        assert nodes([[(0.0, 0.0)]]) == nodes([[(float(i), 1.0) for i in range(50)]] * 6)

    def test_choose_k_prefers_the_true_number(self, blobs):
        got = {r["k"]: r for r in segments.choose_k(blobs, "id", ["x", "y"], [1, 2, 3, 4]).collect()}
        assert got[1]["silhouette"] is None
        assert max((2, 3, 4), key=lambda k: got[k]["silhouette"]) == 3
        assert got[1]["cost"] > got[2]["cost"] > got[3]["cost"] >= got[4]["cost"]

    def test_profile(self, blobs):
        labelled = blobs.withColumnRenamed("blob", "cluster")
        got = segments.cluster_profile(labelled, "cluster", ["x", "y"]).where("cluster = 1").first()
        assert got["n"] == 40 and got["x"] == pytest.approx(10, abs=0.5)


class TestDesign:
    def test_sample_size(self):
        assert experiments.sample_size(0.10, 0.02) == 3839
        for bad in ((0.1, 0.0), (0.0, 0.1), (0.95, 0.1)):
            with pytest.raises(ValueError):
                experiments.sample_size(*bad)

    def test_from_traffic(self, spark):
        data = [(u, dt.datetime(2024, 1, 1 + d), u == 0 and d == 0) for u in range(10) for d in range(4)]
        daily = spark.createDataFrame(data, "u int, day timestamp_ntz, ok boolean")
        got = experiments.ab_design(daily, "u", "day", "ok", 0.02).first()
        assert tuple(got) == (0.1, 10.0, 3839, None)
        none = experiments.ab_design(daily.withColumn("ok", F.lit(False)), "u", "day", "ok", 0.02).first()
        assert (none["baseline"], none["n_per_group"], none["days"]) == (0.0, None, None)
        with pytest.raises(ValueError):
            experiments.ab_design(daily, "u", "day", "ok", 0)

    def test_days_until_enough_users_came(self, spark):
        # 2000 new users a day, a tenth of them successful on their first day.
        daily = spark.range(20000).selectExpr(
            "id AS u", "date_add(DATE '2024-01-01', CAST(id / 2000 AS INT)) AS day", "id % 10 = 0 AS ok"
        )
        got = experiments.ab_design(daily, "u", "day", "ok", 0.02).first()
        assert (got["n_per_group"], got["days"]) == (3839, 4)


class TestAssign:
    def test_stable_disjoint_and_near_weights(self, spark):
        users = spark.range(20000).withColumnRenamed("id", "user")
        weights = {"a": 2, "b": 1, "c": 1}
        one = experiments.assign(users, "user", "s1", weights)
        two = experiments.assign(users.repartition(7), "user", "s1", weights)
        assert one.exceptAll(two).count() == 0
        share = {r["group"]: r["count"] / 20000 for r in one.groupBy("group").count().collect()}
        assert share == {"a": pytest.approx(0.5, abs=0.02), "b": pytest.approx(0.25, abs=0.02), "c": pytest.approx(0.25, abs=0.02)}
        other = experiments.assign(users, "user", "s2", weights, name="g2")
        both = one.join(other, "user").where("group = 'a' AND g2 = 'a'").count() / 20000
        assert both == pytest.approx(0.25, abs=0.02)

    def test_edges(self, spark):
        users = spark.createDataFrame([(1,), (None,)], "user int")
        assert [r["group"] for r in experiments.assign(users, "user", "s", {"all": 1}).collect()] == ["all", None]
        with pytest.raises(ValueError):
            experiments.assign(users, "user", "s", {"a": 0})


class TestHygiene:
    def test_prepare(self, spark, rows):
        t = dt.datetime(2024, 1, 1)
        m = dt.timedelta(minutes=1)
        data = [(1, "msk", t, t + m), (1, "msk", t, t), (1, "spb", t, t + m), (2, "spb", t + m, t), (3, "kzn", t, t + m)]
        df = spark.createDataFrame(data, "user int, city string, started timestamp_ntz, ended timestamp_ntz")
        got = experiments.ab_prepare(df, "user", "city", "started", "ended", ["msk", "spb"])
        assert rows(got) == [(1, "msk", 60, 2), (1, "spb", 60, 1), (2, "spb", 0, 1)]
        assert rows(experiments.overlap(got, "user", "city")) == [(1, 2)]

    def test_overlap_ignores_unassigned(self, spark):
        df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (2, "a")], "u int, g string")
        assert experiments.overlap(df, "u", "g").count() == 0

    def test_srm(self, spark):
        df = spark.range(1000).select("id", F.when(F.col("id") < 600, "a").otherwise("b").alias("g"))
        bad = experiments.srm(df, "g", {"a": 1, "b": 1}).first()
        assert (bad["n"], bad["chi2"]) == (1000, pytest.approx(40.0)) and bad["p"] < 1e-9
        good = experiments.srm(df, "g", {"a": 6, "b": 4}, "id").first()
        assert (good["chi2"], good["p"]) == (0.0, 1.0)
        empty = experiments.srm(df, "g", {"a": 6, "b": 2, "c": 2}).first()
        assert empty["chi2"] > 100 and empty["unplanned"] == 0
        assert experiments.srm(df, "g", {"a": 1.0, "c": 1.0}, "id").first()["unplanned"] == 400


class TestTests:
    # A widely used worked case.
    A = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9, 16.9, 20.1, 21.9, 22.6, 23.1, 19.6, 19.0, 21.7, 21.4]
    B = [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8, 22.0, 24.8, 20.2, 21.9, 22.1, 22.9, 20.5, 24.4]

    @pytest.fixture
    def two(self, spark):
        data = [("a", x) for x in self.A] + [("b", x) for x in self.B] + [("a", None), ("other", 1.0)]
        return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "user int, g string, x double")

    def test_welch(self, two):
        a, b = np.array(self.A), np.array(self.B)
        va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
        t = (b.mean() - a.mean()) / math.sqrt(va + vb)
        df = (va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1))
        got = experiments.welch(two, "g", "x", "a", "b", user="user").first()
        assert (got["n_a"], got["n_b"]) == (15, 15)
        assert (got["t"], got["df"]) == (pytest.approx(t), pytest.approx(df))
        # The usual published p-value of this data set.
        assert got["p"] == pytest.approx(0.021378, abs=1e-6)
        assert got["ci_lo"] < got["diff"] < got["ci_hi"] and got["ci_lo"] > 0

    def test_one_sided(self, two):
        both = experiments.welch(two, "g", "x", "a", "b").first()["p"]
        up = experiments.welch(two, "g", "x", "a", "b", "greater").first()
        down = experiments.welch(two, "g", "x", "a", "b", "less").first()
        assert (up["p"], down["p"]) == (pytest.approx(both / 2), pytest.approx(1 - both / 2))
        assert up["ci_hi"] == math.inf and down["ci_lo"] == -math.inf
        with pytest.raises(ValueError):
            experiments.welch(two, "g", "x", "a", "b", "more")

    def test_repeated_user_fails(self, two):
        with pytest.raises(Exception, match="more than once"):
            experiments.welch(two.unionByName(two.limit(1)), "g", "x", "a", "b", user="user").collect()

    def test_no_spread_gives_no_answer(self, spark):
        df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, x double")
        got = experiments.welch(df, "g", "x", "a", "b").first()
        assert (got["t"], got["p"]) == (None, None)

    def test_ztest(self, spark):
        df = spark.range(2000).select(
            F.when(F.col("id") < 1000, "a").otherwise("b").alias("g"),
            (F.col("id") % 1000 < F.when(F.col("id") < 1000, 100).otherwise(130)).alias("ok"),
        )
        got = experiments.ztest(df, "g", "ok", "a", "b").first()
        z = 0.03 / math.sqrt(0.115 * 0.885 * 2 / 1000)
        assert (got["rate_a"], got["rate_b"]) == (0.1, 0.13)
        assert got["z"] == pytest.approx(z)
        assert got["p"] == pytest.approx(math.erfc(z / math.sqrt(2)))

    def test_report(self, two):
        df = two.withColumn("high", F.col("x") > 22)
        got = {r["metric"]: r for r in experiments.ab_report(df, "g", {"x": "mean", "high": "rate"}, "a", "b", user="user").collect()}
        single = experiments.welch(df, "g", "x", "a", "b").first()
        assert (got["x"]["kind"], got["x"]["stat"], got["x"]["p"]) == ("mean", pytest.approx(single["t"]), pytest.approx(single["p"]))
        assert got["x"]["significant"] and got["x"]["lift"] == pytest.approx(single["diff"] / single["mean_a"])
        assert got["high"]["kind"] == "rate"
        with pytest.raises(ValueError):
            experiments.ab_report(df, "g", {"x": "median"}, "a", "b")


def test_small_groups_get_users(spark):
    users = spark.range(200000).select(F.col("id").alias("u"))
    sizes = dict(experiments.assign(users, "u", "s", {"tiny": 0.0004, "rest": 0.9996}).groupBy("group").count().collect())
    assert 40 < sizes["tiny"] < 130


def test_unknown_values_and_users_are_left_out(spark):
    data = [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0), (4, "b", 5.0), (5, "b", float("nan")), (None, "a", 9.0), (None, "a", 8.0)]
    df = spark.createDataFrame(data, "u int, g string, x double")
    got = experiments.welch(df, "g", "x", "a", "b", user="u").first()
    assert (got["n_a"], got["n_b"], got["diff"]) == (2, 2, 2.5)


def test_cost_is_that_of_the_returned_centres(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(30)], "id int, x double")
    (centres, cost, converged), = segments._lloyd(df, ["x"], [[(0.0,), (1.0,)]], 1, 1e-9)
    want = sum(min((float(i * i) - c[0]) ** 2 for c in centres) for i in range(30))
    assert not converged and cost == pytest.approx(want)
