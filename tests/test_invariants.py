"""Properties that hold on any data, on the given tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture
def run(spark):
    return lambda name: entry.queries()[name](spark, DATA)


def test_everyone_is_active_at_age_zero(run):
    assert run("pm_retention").where("age = 0 AND rate <> 1").count() == 0
    assert run("pm_retention").where("active > size").count() == 0


@pytest.mark.parametrize("name", ["pm_funnel", "pm_funnel_users", "pm_funnel_by_dim"])
def test_funnels_never_widen(run, name):
    assert run(name).where("from_prev > 1 OR from_first > from_prev").count() == 0


@pytest.mark.parametrize("name", ["eda_group_share", "eda_market_share"])
def test_shares_add_up(run, name):
    assert run(name).agg(F.sum("share")).first()[0] == pytest.approx(1, abs=1e-3)


def test_contributions_add_up(run):
    got = run("pm_contribution").agg(F.sum("change"), F.sum("after") - F.sum("before"), F.sum("share")).first()
    assert got[0] == pytest.approx(got[1], abs=0.1) and got[2] == pytest.approx(1, abs=1e-3)


def test_ltv_never_falls(run):
    rows = run("ue_ltv_curve").orderBy("channel", "age").collect()
    for a, b in zip(rows, rows[1:]):
        assert a["channel"] != b["channel"] or a["ltv"] <= b["ltv"]


def test_rfm_cells_hold_all_users(spark, run):
    users = spark.read.parquet(f"{DATA}/orders.parquet").select("o_custkey").distinct().count()
    assert run("seg_rfm_summary").agg(F.sum("customers")).first()[0] == users
    assert run("seg_rfm").where("NOT (r BETWEEN 1 AND 5 AND f BETWEEN 1 AND 5 AND m BETWEEN 1 AND 5)").count() == 0


def test_sessions_hold_all_events(spark, run):
    events = spark.read.parquet(f"{DATA}/events.parquet").count()
    assert run("pm_sessions").agg(F.sum("n_events")).first()[0] == events
    assert run("pm_sessionize").where("session_no IS NOT NULL").count() == events


def test_moves_are_events_minus_users(spark, run):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    users = events.select("user_id").distinct().count()
    assert run("pm_transitions").agg(F.sum("n")).first()[0] == events.count() - users


def test_mart_totals_equal_their_parts(run):
    by_set = {
        (r["g_o_orderstatus"], r["g_o_orderpriority"]): r["n"]
        for r in run("mart_cube").groupBy("g_o_orderstatus", "g_o_orderpriority").agg(F.sum("n").alias("n")).collect()
    }
    assert len(by_set) == 4 and len(set(by_set.values())) == 1
