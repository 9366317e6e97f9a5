"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from growthkit.functions.ordering import with_neighbour
from growthkit.plans import catalog
from growthkit.operators import explore, metrics, paths, prepare
from growthkit.plans.adapters import event_log, event_revenue, order_log, table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")

FITTED = {"seg_kmeans", "seg_choose_k", "seg_cluster_profile"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As if every table were large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - FITTED))
def test_no_cross_join_at_scale(spark, no_broadcast, name):
    text = plan(entry.queries()[name](spark, DATA))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # The library never forces a broadcast; Spark decides by measured size.
    assert "BroadcastHashJoin" not in text


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["prep_slice"](spark, DATA))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", text)
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>", text)
    mau = plan(entry.queries()["pm_mau"](spark, DATA))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in mau


@pytest.mark.parametrize(
    "build",
    [
        lambda s: prepare.dedupe(table(s, DATA, "lineitem"), "l_orderkey", ["l_partkey", "l_suppkey", "l_linenumber"]),
        lambda s: explore.top_k(table(s, DATA, "lineitem"), "l_quantity", 3, "l_returnflag", "l_orderkey"),
    ],
    ids=["dedupe", "top_k"],
)
def test_first_rows_are_picked_before_the_shuffle(spark, build):
    text = plan(build(spark))
    assert text.count("WindowGroupLimit") >= 2
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_top_k_overall_is_no_full_sort(spark):
    text = plan(explore.top_k(table(spark, DATA, "orders"), "o_totalprice", 5, tie="o_orderkey"))
    assert "TakeOrderedAndProject" in text


def windows_by(text: str) -> list[str]:
    return re.findall(r"hashpartitioning\((.*?), \d+\)", text)


@pytest.mark.parametrize(
    "build",
    [
        lambda e: paths.transitions(e, "user_id", "ts", "event_type", "event_id"),
        lambda e: paths.funnel(e, ["view", "click"], "user_id", "ts", "event_type"),
        lambda e: paths.sessions(e, "user_id", "ts", dt.timedelta(hours=6)),
    ],
    ids=["transitions", "funnel", "sessions"],
)
def test_raw_events_are_shuffled_by_user_and_time_slice(spark, build):
    text = plan(build(event_log(spark, DATA)))
    # The deepest exchange is the one that carries raw events.
    assert "__slice" in windows_by(text)[-1]


def test_users_are_reduced_before_the_exchange(spark):
    out = metrics.revenue_per_user(event_log(spark, DATA), "user_id", "ts", event_revenue(), "day")
    text = plan(out)
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_sum") == 2


def test_no_window_gathers_rows_in_one_task(spark, no_broadcast):
    for name in set(catalog.QUERIES) - FITTED:
        text = plan(entry.queries()[name](spark, DATA))
        if "SinglePartition" not in text:
            continue
        # A single task may only receive aggregates or the k best rows: walk down to the first of them.
        for part in text.split("Exchange SinglePartition")[1:]:
            for line in part.splitlines()[1:]:
                if re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate|LocalLimit|TakeOrdered", line):
                    break
                assert not re.search(r"Scan", line), (name, line)


def test_median_shuffles_no_raw_values(spark, no_broadcast):
    """A sketch, then counts: two reads of the table, and what leaves the first tasks is counted already."""
    df = explore.summarize(order_log(spark, DATA), [], "amount")
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    # walk up from each read of the table: an aggregate comes before any exchange
    lines = [re.sub(r"^[ :+*-]*(?:\(\d+\) )?", "", line) for line in final.splitlines()]
    reads = [i for i, line in enumerate(lines) if line.startswith("FileScan")]
    assert reads
    for i in reads:
        above = next(line for line in lines[i::-1] if re.match(r"Exchange|\w*HashAggregate|SortAggregate", line))
        assert "Aggregate" in above, above


SLICED = {
    "sessions": lambda e: paths.sessions(e, "user_id", "ts", dt.timedelta(seconds=1)),
    "sessionize": lambda e: paths.sessionize(e, "user_id", "ts", dt.timedelta(seconds=1)),
    "funnel": lambda e: paths.funnel(e, ["view", "click", "purchase"], "user_id", "ts", "event_type"),
    "transitions": lambda e: paths.transitions(e, "user_id", "ts", "event_type", "event_id"),
    "next order": lambda e: with_neighbour(e, "user_id", "ts", "event_id", "ts"),
}


@pytest.mark.parametrize("name", SLICED)
def test_nothing_is_ordered_or_gathered_by_user_alone(spark, no_broadcast, name):
    """Windows and lists take a user with a time slice or a node of slices, never a user's whole history."""
    text = plan(SLICED[name](event_log(spark, DATA)))
    for keys in re.findall(r"Window \[.*?\], \[([^\]]*)\]", text):
        assert len(keys.split(",")) > 1 or keys.startswith("from"), keys
    for keys in re.findall(r"ObjectHashAggregate\(keys=\[([^\]]*)\], functions=\[(?:partial_)?collect_list", text):
        assert len(keys.split(",")) > 1, keys


@pytest.mark.parametrize("name", ["transitions", "next order"])
def test_raw_rows_are_sorted_once(spark, no_broadcast, name):
    df = SLICED[name](event_log(spark, DATA))
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    # a sort by time is one of raw rows; what else is sorted are slices and nodes
    assert len([line for line in text.splitlines() if re.search(r"Sort \[.*\bts#", line)]) == 1
