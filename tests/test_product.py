"""Explore, listings, product metrics, paths and unit economics on tiny tables."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from growthkit.operators import contribution, explore, listings, metrics, paths, unit_econ

DAY = dt.date


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


EVENTS = "user bigint, ts timestamp_ntz, event string, platform string, revenue double"


@pytest.fixture
def events(spark):
    data = [
        (1, at("2024-01-05 10:00"), "launch", "ios", None),
        (1, at("2024-01-05 10:00"), "purchase", "ios", 5.0),
        (1, at("2024-01-20 10:00"), "launch", "web", None),
        (2, at("2024-01-31 23:59"), "launch", "web", None),
        (2, at("2024-03-01 00:00"), "purchase", "web", 10.0),
        (3, at("2024-02-10 08:00"), "launch", "ios", None),
        (None, at("2024-02-10 08:00"), "launch", "ios", None),
    ]
    return spark.createDataFrame(data, EVENTS)


class TestExplore:
    def test_shares_add_up(self, spark):
        df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), (None, 2.0)], "c string, v double")
        assert explore.group_share(df, "c").agg(F.sum("share")).first()[0] == pytest.approx(1)
        got = {r["c"]: r["share"] for r in explore.market_share(df, "c", "v").collect()}
        assert got == {"a": 0.3, "b": 0.5, None: 0.2}
        cities = spark.createDataFrame([("x", "p", 1), ("x", "q", 3), (None, "r", 2)], "c string, d string, v int")
        inside = {r["d"]: r["share"] for r in explore.market_share(cities, ["c", "d"], "v", within="c").collect()}
        assert inside == {"p": 0.25, "q": 0.75, "r": 1.0}

    def test_summary(self, spark):
        df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 6.0), ("b", None)], "c string, v double")
        got = {r["c"]: r for r in explore.summarize(df, "c", "v").collect()}
        assert (got["a"]["n"], got["a"]["mean"], got["a"]["median"]) == (3, 3.0, 2.0)
        assert got["a"]["sd"] == pytest.approx(7**0.5)
        assert (got["b"]["n"], got["b"]["median"]) == (0, None)
        assert explore.summarize(df, [], "v").first()["n"] == 3

    def test_speaker_twice_counts_once(self, spark):
        df = spark.createDataFrame([("c1", "ann"), ("c1", "ann"), ("c1", "bob"), ("c2", "ann")], "conf string, who string")
        assert tuple(explore.avg_members(df, "conf", "who").first()) == (2, 1.5)

    def test_reaction_coverage(self, spark):
        df = spark.createDataFrame([("t", 4.0), ("t", None), ("u", None)], "topic string, score double")
        got = {r["topic"]: (r["n"], r["n_scored"], r["avg_score"], r["coverage"]) for r in explore.reaction(df, "topic", "score").collect()}
        assert got == {"t": (2, 1, 4.0, 0.5), "u": (1, 0, None, 0.0)}

    def test_top_k_ties_and_nulls(self, spark, rows):
        df = spark.createDataFrame([("g", "b", 5), ("g", "a", 5), ("g", "c", None), ("h", "d", 1)], "g string, n string, v int")
        assert rows(explore.top_k(df, "v", 2, "g", "n").select("g", "n", "rank")) == [("g", "a", 1), ("g", "b", 2), ("h", "d", 1)]
        assert rows(explore.top_k(df, "v", 2, tie="n").select("n", "rank")) == [("a", 1), ("b", 2)]

    def test_top_k_of_many(self, spark):
        df = spark.range(5000).select(F.lit("g").alias("g"), "id", F.pmod(F.xxhash64("id"), F.lit(700)).alias("v"))
        got = {(r["id"], r["rank"]) for r in explore.top_k(df, "v", 1500, "g", "id").collect()}
        best = sorted(df.collect(), key=lambda r: (-r["v"], r["id"]))[:1500]
        assert got == {(r["id"], i) for i, r in enumerate(best, start=1)}

    def test_crosstab(self, spark, rows):
        df = spark.createDataFrame([("x", "p"), ("x", "p"), ("y", "q"), ("y", "other")], "r string, c string")
        assert rows(explore.crosstab(df, "r", "c", ["p", "q"])) == [("x", 2, 0, 0), ("y", 0, 1, 1)]
        assert rows(explore.crosstab(df, "r", "c", ["p"])) == [("x", 2, 0), ("y", 0, 2)]

    def test_outcome(self, spark):
        df = spark.createDataFrame([("elf", True), ("elf", False), ("elf", None), ("orc", False)], "race string, paid boolean")
        got = {r["race"]: (r["n"], r["n_pos"], r["rate"]) for r in explore.outcome_by(df, "race", "paid").collect()}
        assert got == {"elf": (3, 1, pytest.approx(1 / 3)), "orc": (1, 0, 0.0)}

    def test_purchase_activity(self, spark):
        buys = spark.createDataFrame([(1, 10.0), (1, 0.0), (2, 5.0), (9, 1.0)], "id int, amount double")
        users = spark.createDataFrame([(1, "elf"), (2, "elf")], "id int, race string")
        got = {r["race"]: r for r in explore.purchase_activity(buys, "id", "amount", users, "race").collect()}
        assert (got["elf"]["buyers"], got["elf"]["orders"], got["elf"]["orders_per_buyer"], got["elf"]["avg_amount"]) == (2, 3, 1.5, 5.0)
        assert got[None]["buyers"] == 1
        assert explore.purchase_activity(buys, "id", "amount").first()["buyers"] == 3

    def test_compare_groups(self, spark):
        df = spark.createDataFrame([("free", 20, 1.0), ("free", 30, 3.0), ("paid", None, 9.0)], "plan string, age int, km double")
        got = {(r["metric"], r["group"]): (r["n"], r["mean"], r["median"]) for r in explore.compare_groups(df, "plan", ["age", "km"]).collect()}
        assert got[("age", "free")] == (2, 25.0, 25.0)
        assert got[("age", "paid")] == (0, None, None)
        assert got[("km", "paid")] == (1, 9.0, 9.0)

    def test_plan_can_change(self, spark, rows):
        data = [(1, "free", at("2024-01-02"), 5.0), (1, "paid", at("2024-02-02"), 7.0), (2, "free", at("2024-01-09"), 1.0)]
        rides = spark.createDataFrame(data, "u int, plan string, ts timestamp_ntz, r double")
        assert rows(explore.plan_value(rides, "u", "plan", "ts", "r")) == [
            ("free", DAY(2024, 1, 1), 2, 6.0, 3.0),
            ("paid", DAY(2024, 2, 1), 1, 7.0, 7.0),
        ]

    def test_time_budget(self, spark):
        talks = spark.createDataFrame([("c", at("2024-01-02 09:00"), 600), ("c", at("2024-01-02 11:00"), 1200)], "conf string, ts timestamp_ntz, s bigint")
        assert tuple(explore.time_budget(talks, "conf", "s", "ts").first()) == ("c", DAY(2024, 1, 2), 2, 1800, 900.0, 1200)


class TestListings:
    @pytest.fixture
    def flats(self, spark):
        d = DAY
        data = [
            (1, "city", 100.0, d(2024, 1, 1), d(2024, 1, 31)),
            (2, "city", 300.0, d(2024, 1, 1), d(2024, 2, 1)),
            (3, "city", None, d(2024, 1, 1), None),
            (4, "town", 50.0, d(2024, 3, 1), d(2024, 3, 1)),
            (5, None, 70.0, d(2024, 3, 1), d(2024, 3, 2)),
        ]
        return spark.createDataFrame(data, "id int, where string, price double, opened date, closed date")

    def test_bands(self, flats):
        placed = listings.two_way(flats, "where", "city")
        df = listings.activity_segments(placed, "opened", "closed", [30, 90], ["month", "quarter", "longer"], "place", "price")
        got = {(r["place"], r["band"]): (r["n"], r["share"], r["mean_price"], r["median_price"]) for r in df.collect()}
        third = pytest.approx(1 / 3)
        assert got == {
            ("city", "month"): (1, third, 100.0, 100.0),
            ("city", "quarter"): (1, third, 300.0, 300.0),
            ("city", "open"): (1, third, None, None),
            ("rest", "month"): (2, 1.0, 60.0, 60.0),
        }

    def test_seasons(self, flats):
        got = {(r["kind"], r["month"]): (r["n"], r["rank"]) for r in listings.seasonality(flats, {"in": "opened", "out": "closed"}).collect()}
        assert got == {("in", 1): (3, 1), ("in", 3): (2, 2), ("out", 1): (1, 2), ("out", 2): (1, 2), ("out", 3): (2, 1)}
        assert listings.seasonality(flats, {"in": "opened"}, full_years=True).count() == 0

    def test_places(self, flats):
        got = {r["where"]: (r["n"], r["share_removed"], r["avg_days"]) for r in listings.place_activity(flats, "where", "opened", "closed").collect()}
        assert got["city"] == (3, pytest.approx(2 / 3), 30.5)
        assert got["town"] == (1, 1.0, 0.0)
        assert [r["where"] for r in listings.place_activity(flats, "where", "opened", "closed", min_n=2).collect()] == ["city"]


class TestMetrics:
    def test_user_on_two_platforms_counts_on_each(self, events, rows):
        by_platform = rows(metrics.active_users(events, "user", "ts", "month", "platform"))
        assert (DAY(2024, 1, 1), "ios", 1) in by_platform and (DAY(2024, 1, 1), "web", 2) in by_platform
        assert rows(metrics.active_users(events, "user", "ts"))[0] == (DAY(2024, 1, 1), 2)

    def test_dim_from_user_table(self, spark, events, rows):
        users = spark.createDataFrame([(1, "ads"), (2, "ads")], "user bigint, channel string")
        got = rows(metrics.active_users(events, "user", "ts", "month", "channel", users))
        assert (DAY(2024, 1, 1), "ads", 2) in got and (DAY(2024, 2, 1), None, 1) in got
        assert rows(metrics.new_users(events, "user", "ts", users, "channel")) == [(DAY(2024, 1, 1), "ads", 2), (DAY(2024, 2, 1), None, 1)]

    def test_retention_grid(self, events, rows):
        got = rows(metrics.retention(events, "user", "ts"))
        jan, feb = DAY(2024, 1, 1), DAY(2024, 2, 1)
        assert got == [(jan, 0, 2, 2, 1.0), (jan, 1, 2, 0, 0.0), (jan, 2, 2, 1, 0.5), (feb, 0, 1, 1, 1.0), (feb, 1, 1, 0, 0.0)]

    def test_retention_stops_at_the_complete_period(self, events, rows):
        got = rows(metrics.retention(events, "user", "ts", complete_through=DAY(2024, 2, 29)))
        assert [(r[0].month, r[1]) for r in got] == [(1, 0), (1, 1), (2, 0)]
        assert [r[1] for r in rows(metrics.retention(events, "user", "ts", max_age=0))] == [0, 0]

    def test_progress_is_a_mean_of_ratios(self, spark):
        data = [("s1", 1, 2), ("s1", 1, 2), ("s2", 1, 4), ("s2", 2, 4), ("s2", 3, 4), ("s3", None, 5)]
        df = spark.createDataFrame(data, "s string, level int, total int")
        got = metrics.avg_progress(df, "s", "level", "total").first()
        assert tuple(got) == (3, pytest.approx((0.5 + 0.75 + 0) / 3))

    def test_revenue_per_user(self, events):
        got = {r["period"].month: r for r in metrics.revenue_per_user(events, "user", "ts", F.col("revenue")).collect()}
        assert (got[1]["arpau"], got[1]["arppu"]) == (2.5, 5.0)
        assert (got[2]["arpau"], got[2]["arppu"], got[2]["payers"]) == (0.0, None, 0)

    def test_share_over_is_strict(self, spark):
        df = spark.range(21).select(F.when(F.col("id") < 10, 1).otherwise(2).alias("user"))
        assert tuple(metrics.share_over(df, "user", F.lit(True), 10).first()) == (2, 1, 0.5)

    def test_basket(self, spark):
        df = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 30.0)], "o int, a double")
        assert tuple(metrics.basket(df, "o", "a").first()) == (2, 30.0, 1.5, 20.0)
        assert tuple(metrics.basket(df.limit(0), "o", "a").first()) == (0, None, None, None)

    def test_trend_has_no_previous_after_a_gap(self, spark):
        data = [(DAY(2024, 1, 1), 10.0), (DAY(2024, 2, 1), 15.0), (DAY(2024, 4, 1), 3.0), (DAY(2024, 5, 1), 0.0), (DAY(2024, 6, 1), 1.0)]
        df = spark.createDataFrame(data, "period date, revenue double")
        got = [(r["revenue_prev"], r["revenue_change"], r["complete"]) for r in metrics.trend(df, "revenue", complete_through=DAY(2024, 5, 31)).orderBy("period").collect()]
        assert got == [(None, None, True), (10.0, 0.5, True), (None, None, True), (3.0, -1.0, True), (0.0, None, False)]


class TestContribution:
    SPANS = ((DAY(2024, 1, 1), DAY(2024, 2, 1)), (DAY(2024, 2, 1), DAY(2024, 3, 1)))

    @pytest.fixture
    def log(self, spark):
        data = [
            (1, at("2024-01-05 00:00"), "a", 10.0),
            (2, at("2024-01-05 00:00"), "b", None),
            (1, at("2024-02-05 00:00"), "a", 30.0),
            (2, at("2024-02-06 00:00"), "b", 6.0),
            (3, at("2024-02-07 00:00"), "b", None),
            (3, at("2024-03-01 00:00"), "b", 99.0),
        ]
        return spark.createDataFrame(data, "user bigint, ts timestamp_ntz, seg string, r double")

    def test_segments_add_up(self, log, rows):
        got = rows(contribution.contribution(log, "user", "ts", F.col("r"), *self.SPANS, "seg"))
        assert got == [("a", 10.0, 30.0, 20.0, pytest.approx(20 / 26)), ("b", 0.0, 6.0, 6.0, pytest.approx(6 / 26))]

    def test_factors_add_up(self, log):
        got = {r["factor"]: r for r in contribution.decompose(log, "user", "ts", F.col("r"), *self.SPANS).collect()}
        assert got["revenue"]["effect"] == 26.0
        assert sum(r["effect"] for f, r in got.items() if f != "revenue") == pytest.approx(26.0)
        assert (got["audience"]["before"], got["audience"]["after"]) == (2.0, 3.0)

    def test_no_payers_before(self, log):
        got = contribution.decompose(log.where("ts >= '2024-02-01' OR user = 2"), "user", "ts", F.col("r"), *self.SPANS)
        assert all(r["effect"] is None for r in got.where("factor <> 'revenue'").collect())


def slow_funnel(events, steps, within=None):
    """Matched steps per user by a plain loop."""
    reached = {}
    for user in {e[0] for e in events}:
        mine = sorted((t, name) for u, t, name in events if u == user)
        last = None
        first = None
        n = 0
        for step in steps:
            later = [t for t, name in mine if name == step and (last is None or t > last)]
            if not later:
                break
            last = min(later)
            first = first or last
            if within is not None and last - first > within:
                break
            n += 1
        reached[user] = n
    return [sum(1 for n in reached.values() if n > i) for i in range(len(steps))]


class TestPaths:
    def test_equal_times_and_wrong_order_do_not_count(self, events, rows):
        got = rows(paths.funnel(events, ["launch", "purchase"], "user", "ts", "event").select("step", "n"))
        assert got == [("launch", 3), ("purchase", 1)]  # the event without a user is left out

    @pytest.mark.parametrize("seed", range(3))
    @pytest.mark.parametrize("within", [None, dt.timedelta(hours=7)])
    def test_random_paths(self, spark, seed, within):
        rng = random.Random(seed)
        start = dt.datetime(2024, 1, 1)
        steps = ["a", "b", "c", "d"]
        data = [
            (0 if rng.random() < 0.34 else rng.randrange(1, 25), start + dt.timedelta(minutes=5 * rng.randrange(600)), rng.choice("abcdx"))
            for _ in range(300)
        ]
        df = spark.createDataFrame(data, "user bigint, ts timestamp_ntz, event string")
        for grain in ("hour", "month"):
            got = paths.funnel(df, steps, "user", "ts", "event", within=within, grain=grain).orderBy("step_no")
            assert [r["n"] for r in got.collect()] == slow_funnel(data, steps, within)

    def test_funnel_checks_steps(self, events):
        with pytest.raises(ValueError):
            paths.funnel(events, ["launch", "launch"], "user", "ts", "event")

    def test_funnel_by_dim(self, spark, events, rows):
        users = spark.createDataFrame([(1, "ads"), (2, "seo"), (3, "seo")], "user bigint, channel string")
        got = rows(paths.funnel(events.where("user IS NOT NULL"), ["launch", "purchase"], "user", "ts", "event", dims="channel", users=users))
        assert got == [
            ("ads", 1, "launch", 1, 1.0, 1.0),
            ("ads", 2, "purchase", 0, 0.0, 0.0),
            ("seo", 1, "launch", 2, 1.0, 1.0),
            ("seo", 2, "purchase", 1, 0.5, 0.5),
        ]

    def test_transitions(self, spark, rows):
        data = [(1, at("2024-01-01 00:10"), 1, "a"), (1, at("2024-01-01 00:10"), 2, "b"), (1, at("2024-01-03 00:00"), 3, "a"), (2, at("2024-01-01 00:00"), 4, "b")]
        df = spark.createDataFrame(data, "user bigint, ts timestamp_ntz, id int, event string")
        assert rows(paths.transitions(df, "user", "ts", "event", "id")) == [("a", "b", 1, 1.0), ("b", "a", 1, 1.0)]

    @pytest.mark.parametrize("gap", [dt.timedelta(minutes=20), dt.timedelta(hours=3)])
    def test_sessions_equal_a_loop(self, spark, gap):
        rng = random.Random(5)
        start = dt.datetime(2024, 1, 1)
        data = [(i, rng.choice([0, 0, 1, 2, 3]), start + dt.timedelta(minutes=rng.randrange(3000))) for i in range(250)]
        df = spark.createDataFrame(data, "id bigint, user bigint, ts timestamp_ntz")
        want, number, last = {}, {}, {}
        for i, user, ts in sorted(data, key=lambda r: (r[1], r[2], r[0])):
            if user not in last or ts - last[user] > gap:
                number[user] = number.get(user, 0) + 1
            last[user] = ts
            want[i] = number[user]
        got = {r["id"]: r["session_no"] for r in paths.sessionize(df, "user", "ts", gap).collect()}
        assert got == want
        summary = paths.sessions(df, "user", "ts", gap)
        assert summary.count() == sum(number.values())
        assert summary.agg(F.sum("n_events")).first()[0] == len(data)

    def test_a_pause_of_exactly_the_gap_stays_inside(self, spark):
        df = spark.createDataFrame([(1, at("2024-01-01 00:30")), (1, at("2024-01-01 01:30")), (1, None)], "user bigint, ts timestamp_ntz")
        row = paths.sessions(df, "user", "ts", dt.timedelta(hours=1)).collect()
        assert [tuple(r) for r in row] == [(1, 1, at("2024-01-01 00:30"), at("2024-01-01 01:30"), 2, 3600)]
        labelled = paths.sessionize(df, "user", "ts", dt.timedelta(hours=1)).orderBy("ts").collect()
        assert [r["session_no"] for r in labelled] == [None, 1, 1]


class TestUnitEconomics:
    @pytest.fixture
    def log(self, spark):
        data = [
            (1, at("2024-01-01 10:00"), None),
            (1, at("2024-01-02 09:00"), 6.0),
            (2, at("2024-01-02 10:00"), 1.0),
            (3, at("2024-01-01 10:00"), None),
            (4, at("2024-01-04 10:00"), 50.0),
        ]
        return spark.createDataFrame(data, "user bigint, ts timestamp_ntz, r double")

    @pytest.fixture
    def users(self, spark):
        return spark.createDataFrame([(1, "ads"), (2, "ads"), (3, "seo"), (4, "ads")], "user bigint, channel string")

    @pytest.fixture
    def spend(self, spark):
        return spark.createDataFrame([("ads", 4.0), ("tv", 9.0), ("seo", 0.0)], "channel string, cost double")

    def ltv(self, log, users):
        return unit_econ.ltv_curve(log, "user", "ts", F.col("r"), users, "channel", max_age=3)

    def test_ltv_takes_finished_users_only(self, log, users, rows):
        assert rows(self.ltv(log, users).drop("acquired")) == [
            ("ads", 0, 2, 1.0, 0.5),
            ("ads", 1, 2, 7.0, 3.5),
            ("ads", 2, 2, 7.0, 3.5),
            ("seo", 0, 1, 0.0, 0.0),
            ("seo", 1, 1, 0.0, 0.0),
            ("seo", 2, 1, 0.0, 0.0),
        ]

    def test_ltv_without_dim(self, log, rows):
        got = rows(unit_econ.ltv_curve(log, "user", "ts", F.col("r"), max_age=2, observed_through=DAY(2024, 1, 5)))
        assert [r[:3] for r in got] == [(0, 4, 51.0), (1, 4, 57.0)]

    def test_cac_keeps_one_sided_sources(self, users, spend, spark, rows):
        more = users.unionByName(spark.createDataFrame([(9, "friends")], users.schema))
        assert rows(unit_econ.cac(more, spend, "channel")) == [
            ("ads", 3, 4.0, pytest.approx(4 / 3)),
            ("friends", 1, None, None),
            ("seo", 1, 0.0, 0.0),
            ("tv", 0, 9.0, None),
        ]

    def test_roi_and_payback(self, log, users, spend):
        roi = unit_econ.roi_curve(self.ltv(log, users), spend, "channel")
        ads = [r["roi"] for r in roi.where("channel = 'ads'").orderBy("age").collect()]
        # Three users were acquired for 4, two of them are old enough.
        assert ads == pytest.approx([0.5 / (4 / 3) - 1, 3.5 / (4 / 3) - 1, 3.5 / (4 / 3) - 1])
        got = {r["channel"]: (r["payback_age"], r["paid_back"], r["last_roi"]) for r in unit_econ.payback(roi, "channel").collect()}
        assert got == {"ads": (1, True, pytest.approx(1.625)), "seo": (None, False, None)}

    def test_late_users_do_not_raise_the_cost(self, spark):
        data = [(u, dt.datetime(2024, 1, 1 if u < 2 else 9), 10.0) for u in range(10)]
        log = spark.createDataFrame(data, "user int, ts timestamp_ntz, r double")
        users = spark.createDataFrame([(u, "ads") for u in range(10)], "user int, channel string")
        spend = spark.createDataFrame([("ads", 100.0)], "channel string, cost double")
        ltv = unit_econ.ltv_curve(log, "user", "ts", F.col("r"), users, "channel", max_age=3)
        got = unit_econ.roi_curve(ltv, spend, "channel").where("age = 2").first()
        assert (got["users"], got["cac"], got["roi"]) == (2, 10.0, 0.0)

    def test_only_whole_cohorts_take_part(self, spark, rows):
        data = [(1, dt.datetime(2024, 1, 5), 4.0), (2, dt.datetime(2024, 2, 1), 4.0), (2, dt.datetime(2024, 2, 10), 1.0)]
        log = spark.createDataFrame(data, "user int, ts timestamp_ntz, r double")
        ltv = unit_econ.ltv_curve(log, "user", "ts", F.col("r"), max_age=2, cohort="month")
        assert rows(ltv.select("cohort", "age", "users")) == [(DAY(2024, 1, 1), 0, 1), (DAY(2024, 1, 1), 1, 1)]

    def test_within_age(self, spark, log):
        start = log.groupBy("user").agg(F.min("ts").alias("first"))
        got = unit_econ.within_age(log, start, "user", "ts", "first", 1)
        assert got.count() == 4 and got.agg(F.max("age")).first()[0] == 0
        assert got.columns == ["user", "ts", "r", "age"]

    def test_trend_by_source(self, spark, log, users):
        out = unit_econ.trend_by_source(log, "user", "ts", F.col("r"), "channel", users, "day")
        got = {(r["channel"], r["period"].day): (r["revenue"], r["revenue_prev"], r["active"]) for r in out.collect()}
        assert got[("ads", 2)] == (7.0, 0.0, 2)
        assert got[("ads", 4)] == (50.0, None, 1)
