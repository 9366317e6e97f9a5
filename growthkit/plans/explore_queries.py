"""Queries for exploratory aggregates and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from growthkit.operators import explore, listings
from growthkit.plans.adapters import LISTINGS_SQL, USERS_SQL, event_log, listing_dates, order_log, table, user_dim
from growthkit.plans.adapters import listings as listing_rows
from growthkit.plans.data_queries import join_payers
from growthkit.plans.registry import query, rounded
from growthkit.sources.tables import load_tables


def orders_by_user(spark, sf_dir):
    """Orders and amount per customer: user_id, orders, amount."""
    return (
        order_log(spark, sf_dir)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("amount"))
    )


@query(
    "eda_group_share",
    """SELECT p_type, count(*) AS n, round(count(*) / sum(count(*)) OVER () + 1e-9, 4) AS share
 FROM part GROUP BY p_type""",
)
def eda_group_share(spark, sf_dir):
    return rounded(explore.group_share(table(spark, sf_dir, "part"), "p_type"))


@query(
    "eda_market_share",
    f"""SELECT channel, round(sum(o_totalprice) + 1e-9, 2) AS amount,
 round(sum(o_totalprice) / sum(sum(o_totalprice)) OVER () + 1e-9, 4) AS share
 FROM orders JOIN {USERS_SQL} AS u ON user_id = o_custkey GROUP BY channel""",
)
def eda_market_share(spark, sf_dir):
    spend = orders_by_user(spark, sf_dir).join(user_dim(spark, sf_dir), "user_id")
    return rounded(explore.market_share(spend, "channel", "amount"), amount=2)


SUMMARY_SQL = """SELECT event_type, count(value) AS n, round(avg(value) + 1e-9, 4) AS mean,
 round(stddev_samp(value) + 1e-9, 4) AS sd, round({median} + 1e-9, 4) AS median,
 round({p05} + 1e-9, 4) AS p05, round({p95} + 1e-9, 4) AS p95 FROM events GROUP BY event_type"""


@query(
    "eda_summary",
    SUMMARY_SQL.format(
        median="median(value)", p05="quantile_cont(value, 0.05)", p95="quantile_cont(value, 0.95)"
    ),
)
def eda_summary(spark, sf_dir):
    return rounded(explore.summarize(table(spark, sf_dir, "events"), "event_type", "value"))


@query(
    "eda_summary_lines",
    """SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, round(avg(l_extendedprice) + 1e-9, 4) AS mean,
 round(stddev_samp(l_extendedprice) + 1e-9, 4) AS sd, round(median(l_extendedprice) + 1e-9, 4) AS median,
 round(quantile_cont(l_extendedprice, 0.05) + 1e-9, 4) AS p05,
 round(quantile_cont(l_extendedprice, 0.95) + 1e-9, 4) AS p95
 FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def eda_summary_lines(spark, sf_dir):
    return rounded(
        explore.summarize(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    )


@query(
    "eda_avg_members",
    """SELECT count(*) AS containers, round(avg(members) + 1e-9, 4) AS avg_members FROM
 (SELECT count(DISTINCT l_suppkey) AS members FROM lineitem GROUP BY l_orderkey) AS o""",
)
def eda_avg_members(spark, sf_dir):
    return rounded(explore.avg_members(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey"))


@query(
    "eda_reaction",
    """SELECT source, count(*) AS n, count(quality) AS n_scored, round(avg(quality) + 1e-9, 4) AS avg_score,
 round(count(quality) / count(*) + 1e-9, 4) AS coverage
 FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
)
def eda_reaction(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["documents", "labels"])
    scored = t["documents"].select("doc_id", "source").join(t["labels"].select("doc_id", "quality"), "doc_id", "left")
    return rounded(explore.reaction(scored, "source", "quality"))


TOP_SQL = f"""SELECT channel, place, round(sum(o_totalprice) + 1e-9, 2) AS amount
 FROM orders JOIN {USERS_SQL} AS u ON user_id = o_custkey GROUP BY channel, place"""


def _spend_by_place(spark, sf_dir):
    spend = orders_by_user(spark, sf_dir).join(user_dim(spark, sf_dir), "user_id")
    return rounded(spend.groupBy("channel", "place").agg(F.sum("amount").alias("amount")), 2)


@query(
    "eda_topk",
    f"""SELECT *, row_number() OVER (PARTITION BY channel ORDER BY amount DESC, place) AS rank FROM ({TOP_SQL}) AS s
 QUALIFY row_number() OVER (PARTITION BY channel ORDER BY amount DESC, place) <= 3""",
)
def eda_topk(spark, sf_dir):
    return explore.top_k(_spend_by_place(spark, sf_dir), "amount", 3, by="channel", tie="place")


@query(
    "eda_topk_all",
    f"""SELECT *, row_number() OVER (ORDER BY amount DESC, place) AS rank FROM ({TOP_SQL}) AS s
 ORDER BY amount DESC, place LIMIT 5""",
)
def eda_topk_all(spark, sf_dir):
    return explore.top_k(_spend_by_place(spark, sf_dir), "amount", 5, tie="place")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "eda_crosstab",
    "SELECT o_orderstatus, "
    + ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + ", CAST(0 AS BIGINT) AS other FROM orders GROUP BY o_orderstatus",
)
def eda_crosstab(spark, sf_dir):
    return explore.crosstab(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES)


@query(
    "eda_outcome",
    """SELECT c_mktsegment, count(*) AS n, count(*) FILTER (payer) AS n_pos,
 round(avg(CAST(payer AS INTEGER)) + 1e-9, 4) AS rate FROM
 (SELECT c_mktsegment, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS payer
 FROM customer) AS c GROUP BY c_mktsegment""",
)
def eda_outcome(spark, sf_dir):
    return rounded(explore.outcome_by(join_payers(spark, sf_dir), "c_mktsegment", "payer"))


@query(
    "eda_corr",
    "SELECT count(*) AS n, round(corr(l_quantity, l_extendedprice) + 1e-9, 4) AS corr FROM lineitem",
)
def eda_corr(spark, sf_dir):
    return rounded(explore.corr(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice"))


@query(
    "eda_purchase_activity",
    f"""SELECT platform, count(*) AS buyers, CAST(sum(n) AS BIGINT) AS orders,
 round(sum(n) / count(*) + 1e-9, 4) AS orders_per_buyer, round(sum(s) / sum(n) + 1e-9, 2) AS avg_amount,
 round(sum(s) / count(*) + 1e-9, 2) AS amount_per_buyer
 FROM (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS s FROM orders GROUP BY o_custkey) AS o
 JOIN {USERS_SQL} AS u ON user_id = o_custkey GROUP BY platform""",
)
def eda_purchase_activity(spark, sf_dir):
    out = explore.purchase_activity(
        order_log(spark, sf_dir), "user_id", "amount", user_dim(spark, sf_dir), "platform"
    )
    return rounded(out, avg_amount=2, amount_per_buyer=2)


@query(
    "eda_compare",
    """WITH c AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'subscribed' ELSE 'free' END AS g, c_acctbal,
  coalesce(n, 0) AS orders FROM customer LEFT JOIN
  (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) AS o ON o_custkey = c_custkey)
 SELECT 'c_acctbal' AS metric, g AS "group", count(*) AS n, round(avg(c_acctbal) + 1e-9, 4) AS mean,
  round(median(c_acctbal) + 1e-9, 4) AS median FROM c GROUP BY g
 UNION ALL SELECT 'orders', g, count(*), round(avg(orders) + 1e-9, 4), round(median(orders) + 1e-9, 4)
  FROM c GROUP BY g""",
)
def eda_compare(spark, sf_dir):
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        "c_acctbal",
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("subscribed")).otherwise(F.lit("free")).alias("plan"),
    )
    usage = users.join(orders_by_user(spark, sf_dir), "user_id", "left").fillna({"orders": 0})
    return rounded(explore.compare_groups(usage, "plan", ["c_acctbal", "orders"]))


@query(
    "eda_plan_value",
    f"""SELECT platform AS plan, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
 count(DISTINCT o_custkey) AS users, round(sum(o_totalprice) + 1e-9, 2) AS revenue,
 round(sum(o_totalprice) / count(DISTINCT o_custkey) + 1e-9, 2) AS per_user
 FROM orders JOIN {USERS_SQL} AS u ON user_id = o_custkey GROUP BY 1, 2""",
)
def eda_plan_value(spark, sf_dir):
    out = explore.plan_value(
        order_log(spark, sf_dir), "user_id", "platform", "ts", "amount", user_dim(spark, sf_dir)
    )
    return rounded(out, 2)


@query(
    "eda_time_budget",
    """SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total, round(avg(n_chars) + 1e-9, 4) AS mean,
 max(n_chars) AS longest FROM documents GROUP BY source""",
)
def eda_time_budget(spark, sf_dir):
    return rounded(explore.time_budget(table(spark, sf_dir, "documents"), "source", "n_chars"))


@query(
    "eda_time_budget_daily",
    """SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value) + 1e-9, 2) AS total,
 round(avg(value) + 1e-9, 4) AS mean, max(value) AS longest FROM events GROUP BY 1, 2""",
)
def eda_time_budget_daily(spark, sf_dir):
    return rounded(explore.time_budget(event_log(spark, sf_dir), "event_type", "value", "ts"), total=2)


ACTIVITY_BANDS = ["up to 30", "31-90", "91-180", "over 180"]


@query(
    "re_activity",
    f"""WITH l AS (SELECT CASE WHEN channel = 'EUROPE' THEN 'EUROPE' ELSE 'rest' END AS place, price,
  CASE WHEN closed IS NULL THEN 'open' WHEN date_diff('day', opened, closed) <= 30 THEN 'up to 30'
  WHEN date_diff('day', opened, closed) <= 90 THEN '31-90'
  WHEN date_diff('day', opened, closed) <= 180 THEN '91-180' ELSE 'over 180' END AS band
  FROM {LISTINGS_SQL} AS l JOIN (SELECT user_id, channel FROM {USERS_SQL} AS x) AS u ON user_id = o_custkey)
 SELECT place, band, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY place) + 1e-9, 4) AS share,
 round(avg(price) + 1e-9, 2) AS mean_price, round(median(price) + 1e-9, 2) AS median_price
 FROM l GROUP BY place, band""",
)
def re_activity(spark, sf_dir):
    rows = listings.two_way(listing_rows(spark, sf_dir), "channel", "EUROPE")
    out = listings.activity_segments(rows, "opened", "closed", [30, 90, 180], ACTIVITY_BANDS, "place", "price")
    return rounded(out, share=4, mean_price=2, median_price=2)


@query(
    "re_two_way",
    f"""SELECT CASE WHEN channel = 'EUROPE' THEN 'EUROPE' ELSE 'rest' END AS place, count(*) AS n,
 round(avg(o_totalprice) + 1e-9, 2) AS mean_price
 FROM orders JOIN {USERS_SQL} AS u ON user_id = o_custkey GROUP BY 1""",
)
def re_two_way(spark, sf_dir):
    spend = orders_by_user(spark, sf_dir).join(user_dim(spark, sf_dir).drop("place"), "user_id")
    by_place = (
        listings.two_way(spend, "channel", "EUROPE")
        .groupBy("place")
        .agg(F.sum("orders").alias("n"), F.sum("amount").alias("amount"))
    )
    return rounded(by_place.select("place", "n", (F.col("amount") / F.col("n")).alias("mean_price")), 2)


@query(
    "re_seasonality",
    f"""WITH d AS (SELECT 'published' AS kind, opened AS day FROM {LISTINGS_SQL} AS a
  UNION ALL SELECT 'removed', closed FROM {LISTINGS_SQL} AS b),
 m AS (SELECT kind, year(day) AS y, month(day) AS month, count(*) AS n FROM d WHERE day IS NOT NULL GROUP BY 1, 2, 3
  QUALIFY count(*) OVER (PARTITION BY kind, year(day)) = 12),
 s AS (SELECT kind, month, CAST(sum(n) AS BIGINT) AS n FROM m GROUP BY 1, 2)
 SELECT kind, CAST(month AS BIGINT) AS month, n, round(n / sum(n) OVER (PARTITION BY kind) + 1e-9, 4) AS share,
 rank() OVER (PARTITION BY kind ORDER BY n DESC) AS rank FROM s""",
)
def re_seasonality(spark, sf_dir):
    return rounded(
        listings.seasonality(
            listing_dates(spark, sf_dir), {"published": "opened", "removed": "closed"}, full_years=True
        )
    )


@query(
    "re_places",
    f"""SELECT place, count(*) AS n, round(avg(CAST(closed IS NOT NULL AS INTEGER)) + 1e-9, 4) AS share_removed,
 round(avg(date_diff('day', opened, closed)) + 1e-9, 4) AS avg_days
 FROM {LISTINGS_SQL} AS l JOIN {USERS_SQL} AS u ON user_id = o_custkey
 GROUP BY place HAVING count(*) >= 100 ORDER BY n DESC, place LIMIT 10""",
)
def re_places(spark, sf_dir):
    return rounded(
        listings.place_activity(listing_rows(spark, sf_dir), "place", "opened", "closed", min_n=100, top=10)
    )


PLATFORMS = ["automobile", "building", "furniture", "household", "machinery"]


@query(
    "re_crosstab",
    f"""SELECT place, {", ".join(f"count(*) FILTER (platform = '{p.upper()}') AS {p}" for p in PLATFORMS)},
 CAST(0 AS BIGINT) AS other FROM orders JOIN {USERS_SQL} AS u ON user_id = o_custkey GROUP BY place""",
)
def re_crosstab(spark, sf_dir):
    rows = listing_rows(spark, sf_dir).withColumn("platform", F.lower("platform"))
    return explore.crosstab(rows, "place", "platform", PLATFORMS)
