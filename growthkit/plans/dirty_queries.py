"""Queries over awkward rows made from the given tables: unknown users and times, tiny groups, long tails,
late cohorts, values close together."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from growthkit.operators import experiments, explore, marts, metrics, paths, prepare, segments, unit_econ
from growthkit.plans.adapters import USERS_SQL, event_log, event_revenue, order_log, table, user_dim
from growthkit.plans.group_queries import AS_OF, RFM_SQL
from growthkit.plans.product_queries import GAP, LAST_FULL_MONTH, STEPS, user_days
from growthkit.plans.registry import query, rounded

# Events without a user in every seventh row, without a time in every eleventh.
GAPS_SQL = """(SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id,
 CASE WHEN event_id % 11 <> 0 THEN ts END AS ts, event_type, value FROM events)"""


def gappy(spark, sf_dir):
    return event_log(spark, sf_dir).withColumns(
        {
            "user_id": F.when(F.col("event_id") % 7 != 0, F.col("user_id")),
            "ts": F.when(F.col("event_id") % 11 != 0, F.col("ts")),
        }
    )


@query(
    "pm_funnel_anonymous",
    f"""WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_type FROM {GAPS_SQL} AS g
  WHERE user_id IS NOT NULL AND ts IS NOT NULL),
 a AS (SELECT user_id, day, min(ts) AS t FROM e WHERE event_type = 'view' GROUP BY 1, 2),
 b AS (SELECT user_id, day, min(ts) AS t FROM e JOIN a USING (user_id, day) WHERE event_type = 'click' AND ts > t GROUP BY 1, 2),
 c AS (SELECT user_id, day, min(ts) AS t FROM e JOIN b USING (user_id, day) WHERE event_type = 'purchase' AND ts > t GROUP BY 1, 2),
 n AS (SELECT (SELECT count(*) FROM a) AS n1, (SELECT count(*) FROM b) AS n2, (SELECT count(*) FROM c) AS n3)
 SELECT CAST(1 AS BIGINT) AS step_no, 'view' AS step, n1 AS n FROM n UNION ALL SELECT 2, 'click', n2 FROM n
 UNION ALL SELECT 3, 'purchase', n3 FROM n""",
)
def pm_funnel_anonymous(spark, sf_dir):
    events = gappy(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return paths.funnel(events, STEPS, ["user_id", "day"], "ts", "event_type").select("step_no", "step", "n")


@query(
    "pm_sessions_anonymous",
    f"""WITH e AS (SELECT user_id, ts FROM {GAPS_SQL} AS g WHERE user_id IS NOT NULL AND ts IS NOT NULL),
 s AS (SELECT user_id, count(*) AS n, sum(CASE WHEN ts - before <= INTERVAL 6 HOUR THEN 0 ELSE 1 END) AS sessions FROM
  (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM e) AS x GROUP BY user_id)
 SELECT user_id, CAST(sessions AS BIGINT) AS sessions, n AS n_events FROM s""",
)
def pm_sessions_anonymous(spark, sf_dir):
    visits = paths.sessions(gappy(spark, sf_dir), "user_id", "ts", GAP)
    return visits.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n_events").alias("n_events"))


@query(
    "pm_sessions_short_gap",
    """WITH e AS (SELECT l_suppkey AS user_id, o_orderdate + to_seconds(l_partkey % 5000) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 s AS (SELECT user_id, ts, sum(CASE WHEN ts - before <= INTERVAL 1 SECOND THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts
   ROWS UNBOUNDED PRECEDING) AS session_no FROM
  (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM e) AS x)
 SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS started, max(ts) AS ended, count(*) AS n_events,
 date_sub('second', min(ts), max(ts)) AS seconds FROM s GROUP BY 1, 2""",
)
def pm_sessions_short_gap(spark, sf_dir):
    """Nearly every event is a session: the numbers must run through years of a user's slices."""
    at = "o_orderdate + make_interval(0, 0, 0, 0, 0, 0, l_partkey % 5000)"
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
    events = lines.select(F.col("l_suppkey").alias("user_id"), F.expr(at).alias("ts"))
    return paths.sessions(events, "user_id", "ts", dt.timedelta(seconds=1))


@query(
    "pm_transitions_untimed",
    f"""WITH m AS (SELECT event_type AS f, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS t
  FROM {GAPS_SQL} AS g WHERE user_id IS NOT NULL AND ts IS NOT NULL)
 SELECT f AS "from", t AS "to", count(*) AS n FROM m WHERE t IS NOT NULL GROUP BY f, t""",
)
def pm_transitions_untimed(spark, sf_dir):
    return paths.transitions(gappy(spark, sf_dir), "user_id", "ts", "event_type", "event_id").drop("share")


@query(
    "pm_basket_ownerless",
    """SELECT count(DISTINCT l_orderkey) AS orders, round(sum(l_extendedprice) / count(DISTINCT l_orderkey) + 1e-9, 4)
 AS avg_check, round(count(*) / count(DISTINCT l_orderkey) + 1e-9, 4) AS avg_items,
 round(avg(l_extendedprice) + 1e-9, 4) AS avg_item_price FROM lineitem WHERE l_partkey % 7 <> 0""",
)
def pm_basket_ownerless(spark, sf_dir):
    owned = F.when(F.col("l_partkey") % 7 != 0, F.col("l_orderkey"))
    lines = table(spark, sf_dir, "lineitem").withColumn("l_orderkey", owned)
    return rounded(metrics.basket(lines, "l_orderkey", "l_extendedprice"))


@query(
    "eda_plan_value_anonymous",
    f"""SELECT platform AS plan, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
 count(DISTINCT o_custkey) AS users, round(sum(o_totalprice) + 1e-9, 2) AS revenue,
 round(sum(o_totalprice) / count(DISTINCT o_custkey) + 1e-9, 2) AS per_user
 FROM orders JOIN {USERS_SQL} AS u ON user_id = o_custkey WHERE o_orderkey % 7 <> 0 GROUP BY 1, 2""",
)
def eda_plan_value_anonymous(spark, sf_dir):
    owned = F.when(F.col("order_id") % 7 != 0, F.col("user_id"))
    orders = order_log(spark, sf_dir).withColumn("user_id", owned)
    return rounded(explore.plan_value(orders, "user_id", "platform", "ts", "amount", user_dim(spark, sf_dir)), 2)


@query(
    "ab_assign_small",
    """SELECT o_orderkey, CASE WHEN place < 0.00004 THEN 'tiny' WHEN place < 0.00104 THEN 'small' ELSE 'rest' END AS "group"
 FROM (SELECT o_orderkey, CAST('0x' || substr(md5('rare:' || CAST(o_orderkey AS VARCHAR)), 1, 12) AS BIGINT) / pow(2, 48)
 AS place FROM orders) AS s""",
)
def ab_assign_small(spark, sf_dir):
    users = table(spark, sf_dir, "orders").select("o_orderkey")
    return experiments.assign(users, "o_orderkey", "rare", {"tiny": 0.00004, "small": 0.001, "rest": 0.99896})


@query(
    "ab_srm_unplanned",
    """WITH x AS (SELECT count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS a, count(*) FILTER (c_mktsegment = 'BUILDING') AS b,
 count(*) AS t FROM customer)
 SELECT a + b AS n, CAST(2 AS BIGINT) AS groups, t - a - b AS unplanned,
 round(pow(a - (a + b) * 0.6, 2) / ((a + b) * 0.6) + pow(b - (a + b) * 0.4, 2) / ((a + b) * 0.4) + 1e-9, 6) AS chi2 FROM x""",
)
def ab_srm_unplanned(spark, sf_dir):
    users = table(spark, sf_dir, "customer")
    out = experiments.srm(users, "c_mktsegment", {"AUTOMOBILE": 0.6, "BUILDING": 0.4}, "c_custkey")
    return rounded(out.drop("p"), 6)


@query(
    "eda_topk_large",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, rank FROM (SELECT *,
 row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey)
 AS rank FROM lineitem) AS s WHERE rank <= 1500""",
)
def eda_topk_large(spark, sf_dir):
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", *tie, "l_extendedprice")
    return explore.top_k(lines, "l_extendedprice", 1500, "l_returnflag", tie)


@query(
    "eda_crosstab_other",
    """SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS "1-URGENT",
 count(*) FILTER (o_orderpriority <> '1-URGENT') AS other FROM orders GROUP BY o_orderstatus""",
)
def eda_crosstab_other(spark, sf_dir):
    return explore.crosstab(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", ["1-URGENT"])


@query(
    "eda_summary_rate",
    """SELECT l_returnflag, count(*) AS n, round(avg(x) * 1e6 + 1e-9, 4) AS mean, round(median(x) * 1e6 + 1e-9, 4) AS median,
 round(quantile_cont(x, 0.05) * 1e6 + 1e-9, 4) AS p05, round(quantile_cont(x, 0.95) * 1e6 + 1e-9, 4) AS p95
 FROM (SELECT l_returnflag, l_tax / 1000 + l_extendedprice / 1e12 AS x FROM lineitem) AS s GROUP BY l_returnflag""",
)
def eda_summary_rate(spark, sf_dir):
    rate = (F.col("l_tax") / 1000 + F.col("l_extendedprice") / 1e12).alias("x")
    out = explore.summarize(table(spark, sf_dir, "lineitem").select("l_returnflag", rate), "l_returnflag", "x")
    points = ["mean", "median", "p05", "p95"]
    return rounded(out.select("l_returnflag", "n", *[(F.col(c) * 1e6).alias(c) for c in points]))


@query(
    "prep_fence_epoch",
    """SELECT o_orderkey, epoch FROM (SELECT o_orderkey, epoch(o_orderdate)::BIGINT AS epoch FROM orders) AS o,
 (SELECT quantile_cont(epoch(o_orderdate), 0.1) AS lo, quantile_cont(epoch(o_orderdate), 0.9) AS hi FROM orders) AS q
 WHERE epoch BETWEEN lo AND hi""",
)
def prep_fence_epoch(spark, sf_dir):
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("epoch")
    return prepare.fence(table(spark, sf_dir, "orders").select("o_orderkey", seconds), "epoch", 0.1, 0.9)


@query(
    "pm_progress_monthly",
    f"""SELECT CAST(date_trunc('week', t) AS DATE) AS period, count(*) AS sessions, round(avg(done / 5) + 1e-9, 6) AS avg_progress
 FROM (SELECT count(DISTINCT event_type) AS done, min(ts) AS t FROM {GAPS_SQL} AS g WHERE user_id IS NOT NULL
 AND ts IS NOT NULL GROUP BY user_id, CAST(ts AS DATE)) AS s GROUP BY 1""",
)
def pm_progress_monthly(spark, sf_dir):
    # The log covers one month, so weeks stand for months.
    events = gappy(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return rounded(metrics.avg_progress(events, ["user_id", "day"], "event_type", 5, "ts", "week"), 6)


@query(
    "pm_share_over_monthly",
    f"""SELECT period, channel, count(*) AS users, count(*) FILTER (n > 1) AS over, round(avg(CAST(n > 1 AS INTEGER)) + 1e-9, 4)
 AS share FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, channel, o_custkey, count(*) AS n
 FROM orders JOIN {USERS_SQL} AS u ON user_id = o_custkey GROUP BY 1, 2, 3) AS s GROUP BY 1, 2""",
)
def pm_share_over_monthly(spark, sf_dir):
    out = metrics.share_over(
        order_log(spark, sf_dir), "user_id", F.lit(True), 1, "ts", "month", "channel", user_dim(spark, sf_dir)
    )
    return rounded(out)


@query(
    "pm_basket_monthly",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderstatus, count(DISTINCT l_orderkey) AS orders,
 sum(l_extendedprice) AS v, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
 p AS (SELECT *, lag(period) OVER w AS before, lag(round(v / orders + 1e-9, 4)) OVER w AS x FROM m
  WINDOW w AS (PARTITION BY o_orderstatus ORDER BY period))
 SELECT o_orderstatus, period, round(v / orders + 1e-9, 4) AS avg_check,
 CASE WHEN before = period - INTERVAL 1 MONTH THEN x END AS avg_check_prev FROM p""",
)
def pm_basket_monthly(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    lines = table(spark, sf_dir, "lineitem")
    monthly = metrics.basket(lines, "l_orderkey", "l_extendedprice", orders, "o_orderdate", "month", "o_orderstatus")
    out = metrics.trend(monthly, "avg_check", by="o_orderstatus")
    return rounded(out.drop("avg_check_change", "complete"))


@query(
    "pm_retention_by_channel",
    f"""WITH a AS (SELECT DISTINCT channel, o_custkey AS u, CAST(date_trunc('month', o_orderdate) AS DATE) AS m
  FROM orders JOIN {USERS_SQL} AS x ON user_id = o_custkey),
 c AS (SELECT u, min(m) AS cohort FROM a GROUP BY u),
 n AS (SELECT channel, cohort, (year(m) - year(cohort)) * 12 + month(m) - month(cohort) AS age, count(*) AS active
  FROM a JOIN c USING (u) GROUP BY 1, 2, 3),
 s AS (SELECT channel, cohort, active AS size, unnest(generate_series(0, least(6,
  (2001 - year(cohort)) * 12 + 7 - month(cohort)))) AS age FROM n WHERE age = 0 AND cohort <= DATE '2001-07-01')
 SELECT channel, cohort, age, size, coalesce(active, 0) AS active, round(coalesce(active, 0) / size + 1e-9, 4) AS rate
 FROM s LEFT JOIN n USING (channel, cohort, age)""",
)
def pm_retention_by_channel(spark, sf_dir):
    out = metrics.retention(
        order_log(spark, sf_dir),
        "user_id",
        "ts",
        max_age=6,
        complete_through=LAST_FULL_MONTH,
        dims="channel",
        users=user_dim(spark, sf_dir),
    )
    return rounded(out)


# A hundredth of what finished orders brought stands for the spend of a channel and month.
@query(
    "ue_roi_cohort",
    f"""WITH f AS (SELECT o_custkey AS u, min(CAST(o_orderdate AS DATE)) AS d0 FROM orders GROUP BY 1),
 c AS (SELECT u, d0, CAST(date_trunc('month', d0) AS DATE) AS cohort, channel FROM f JOIN {USERS_SQL} AS x ON user_id = u
  WHERE last_day(d0) + 27 <= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)),
 n AS (SELECT channel, cohort, count(*) AS users FROM c GROUP BY 1, 2),
 g AS (SELECT *, unnest(generate_series(0, 27)) AS age FROM n),
 ltv AS (SELECT channel, cohort, age, users, (SELECT coalesce(sum(o_totalprice), 0) FROM orders JOIN c ON u = o_custkey
   WHERE c.channel = g.channel AND c.cohort = g.cohort AND CAST(o_orderdate AS DATE) - d0 <= g.age) / users AS ltv FROM g),
 s AS (SELECT channel, CAST(date_trunc('month', o_orderdate) AS DATE) AS cohort, sum(o_totalprice) * 0.01 AS cost
  FROM orders JOIN {USERS_SQL} AS x ON user_id = o_custkey WHERE o_orderstatus = 'F' GROUP BY 1, 2)
 SELECT channel, cohort, age, users, round(ltv + 1e-9, 4) AS ltv, round(cost / users + 1e-9, 4) AS cac,
 round((ltv - cost / users) / nullif(cost / users, 0) + 1e-9, 4) AS roi FROM ltv LEFT JOIN s USING (channel, cohort)""",
)
def ue_roi_cohort(spark, sf_dir):
    orders, users = order_log(spark, sf_dir), user_dim(spark, sf_dir)
    ltv = unit_econ.ltv_curve(orders, "user_id", "ts", F.col("amount"), users, "channel", 28, cohort="month")
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    spend = (
        done.groupBy(F.col("o_custkey").alias("user_id"), F.trunc("o_orderdate", "month").alias("cohort"))
        .agg((F.sum("o_totalprice") * 0.01).alias("cost"))
        .join(users, "user_id")
    )
    return rounded(unit_econ.roi_curve(ltv, spend, ["channel", "cohort"]))


@query(
    "seg_rfm_named",
    RFM_SQL
    + """, hi AS (SELECT *, r >= 4 AS hr, f >= 4 AS hf, m >= 4 AS hm, r <= 2 AS lr, f <= 2 AS lf FROM rfm)
 SELECT segment, count(*) AS customers, round(sum(monetary) + 1e-9, 2) AS revenue FROM (SELECT monetary, CASE
  WHEN hr AND hf AND hm THEN 'champions' WHEN hr AND hf THEN 'loyal' WHEN hr AND hm THEN 'big spenders'
  WHEN hr AND lf THEN 'new' WHEN lr AND (hf OR hm) THEN 'at risk' WHEN lr AND lf THEN 'lost' ELSE 'regular' END AS segment
  FROM hi) AS s GROUP BY segment""",
)
def seg_rfm_named(spark, sf_dir):
    named = segments.rfm_segments(segments.rfm(order_log(spark, sf_dir), "user_id", "ts", "amount", AS_OF))
    out = named.groupBy("segment").agg(F.count("*").alias("customers"), F.sum("monetary").alias("revenue"))
    return rounded(out, 2)


KNOWN_SQL = f"(SELECT * FROM {GAPS_SQL} AS g WHERE user_id IS NOT NULL AND ts IS NOT NULL)"


@query(
    "pm_mau_untimed",
    f"""SELECT CAST(date_trunc('month', ts) AS DATE) AS period, platform, count(DISTINCT user_id) AS users
 FROM {KNOWN_SQL} AS e JOIN {USERS_SQL} AS u USING (user_id) GROUP BY 1, 2""",
)
def pm_mau_untimed(spark, sf_dir):
    return metrics.active_users(gappy(spark, sf_dir), "user_id", "ts", "month", "platform", user_dim(spark, sf_dir))


@query(
    "pm_new_users_untimed",
    f"""WITH f AS (SELECT user_id, min(ts) AS ts FROM {KNOWN_SQL} AS e WHERE event_id % 40 = 1 GROUP BY user_id)
 SELECT CAST(date_trunc('week', ts) AS DATE) AS period, channel, count(*) AS new_users
 FROM f JOIN {USERS_SQL} AS u USING (user_id) GROUP BY 1, 2""",
)
def pm_new_users_untimed(spark, sf_dir):
    """Some users have no event with a time: they are new in no period."""
    some = gappy(spark, sf_dir).where("event_id % 40 = 1")
    return metrics.new_users(some, "user_id", "ts", user_dim(spark, sf_dir), "channel", "week")


@query(
    "pm_arpau_untimed",
    f"""SELECT CAST(ts AS DATE) AS period, count(DISTINCT user_id) AS active,
 round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) + 1e-9, 2) AS revenue,
 round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) / count(DISTINCT user_id) + 1e-9, 4) AS arpau
 FROM {KNOWN_SQL} AS e GROUP BY 1""",
)
def pm_arpau_untimed(spark, sf_dir):
    return rounded(metrics.arpau(gappy(spark, sf_dir), "user_id", "ts", event_revenue(), "day"), revenue=2)


@query(
    "eda_plan_value_untimed",
    f"""SELECT platform AS plan, CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS users,
 round(sum(value) + 1e-9, 2) AS revenue, round(sum(value) / count(DISTINCT user_id) + 1e-9, 2) AS per_user
 FROM {KNOWN_SQL} AS e JOIN {USERS_SQL} AS u USING (user_id) GROUP BY 1, 2""",
)
def eda_plan_value_untimed(spark, sf_dir):
    return rounded(explore.plan_value(gappy(spark, sf_dir), "user_id", "platform", "ts", "value", user_dim(spark, sf_dir)), 2)


@query(
    "ab_overlap_anonymous",
    f"""SELECT user_id, count(DISTINCT event_type) AS n_groups FROM {GAPS_SQL} AS g WHERE user_id IS NOT NULL
 GROUP BY user_id HAVING count(DISTINCT event_type) > 1""",
)
def ab_overlap_anonymous(spark, sf_dir):
    return experiments.overlap(gappy(spark, sf_dir), "user_id", "event_type")


@query(
    "ab_srm_anonymous",
    f"""WITH c AS (SELECT user_id % 2 AS half, count(DISTINCT user_id) AS n FROM {GAPS_SQL} AS g WHERE user_id IS NOT NULL GROUP BY 1),
 x AS (SELECT CAST(sum(n) AS BIGINT) AS n, sum((n - t / 2) * (n - t / 2) / (t / 2)) AS chi2
  FROM (SELECT n, sum(n) OVER () AS t FROM c) AS y)
 SELECT n, CAST(2 AS BIGINT) AS groups, CAST(0 AS BIGINT) AS unplanned, round(chi2 + 1e-9, 6) AS chi2 FROM x""",
)
def ab_srm_anonymous(spark, sf_dir):
    halves = gappy(spark, sf_dir).withColumn("half", F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd"))
    return rounded(experiments.srm(halves, "half", {"even": 1.0, "odd": 1.0}, "user_id").drop("p"), 6)


@query(
    "ab_prepare_anonymous",
    f"""WITH s AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, min(ts) AS a, max(ts) AS b FROM {KNOWN_SQL} AS e GROUP BY 1, 2, 3)
 SELECT user_id, event_type, CAST(sum(date_sub('second', a, b)) AS BIGINT) AS seconds, count(*) AS n_sessions
 FROM s WHERE event_type IN ('view', 'click') GROUP BY 1, 2""",
)
def ab_prepare_anonymous(spark, sf_dir):
    days = (
        gappy(spark, sf_dir)
        .where("ts IS NOT NULL")
        .groupBy("user_id", "event_type", F.to_date("ts").alias("day"))
        .agg(F.min("ts").alias("started"), F.max("ts").alias("ended"))
    )
    return experiments.ab_prepare(days, "user_id", "event_type", "started", "ended", ["view", "click"])


LARGE = 2**60 + 1


@query(
    "prep_fill_long",
    f"""WITH r AS (SELECT l_returnflag AS flag, CASE WHEN l_partkey % 7 <> 0 THEN {LARGE} + l_partkey END AS v FROM lineitem),
 s AS (SELECT flag, v, row_number() OVER (PARTITION BY flag ORDER BY v) AS place, count(*) OVER (PARTITION BY flag) AS n
  FROM r WHERE v IS NOT NULL),
 m AS (SELECT flag, CAST((CAST(min(v) AS HUGEINT) + max(v) + 1) // 2 AS BIGINT) AS med FROM s
  WHERE place IN ((n + 1) // 2, n // 2 + 1) GROUP BY flag)
 SELECT flag, coalesce(v, med) AS v, count(*) AS n FROM r JOIN m USING (flag) GROUP BY 1, 2""",
)
def prep_fill_long(spark, sf_dir):
    """Whole numbers beyond 2^53: what is known stays as it is, and the medians are exact."""
    value = F.when(F.col("l_partkey") % 7 != 0, F.lit(LARGE) + F.col("l_partkey"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), value.alias("v"))
    return prepare.fill_missing(rows, ["v"], by=["flag"]).groupBy("flag", "v").agg(F.count("*").alias("n"))


@query(
    "eda_topk_half",
    """WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 5 = 0 THEN 7777 WHEN l_partkey % 9 = 0 THEN NULL
  ELSE l_extendedprice END AS price FROM lineitem),
 s AS (SELECT *, row_number() OVER (ORDER BY price DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rank FROM h)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price, rank FROM s WHERE rank <= 50000""",
)
def eda_topk_half(spark, sf_dir):
    """Most of a table, a fifth of it with one value and a part of it unknown (as NaN), ranked without one task for all."""
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    price = "CASE WHEN l_partkey % 5 = 0 THEN 7777D WHEN l_partkey % 9 = 0 THEN double('NaN') ELSE l_extendedprice END"
    lines = table(spark, sf_dir, "lineitem").select(*tie, F.expr(price).alias("price"))
    best = explore.top_k(lines, "price", 50000, tie=tie)
    return best.withColumn("price", F.when(~F.isnan("price"), F.col("price")))


@query(
    "eda_market_share_unknown",
    """WITH g AS (SELECT event_type, CASE WHEN event_id % 13 <> 0 THEN value END AS value FROM events)
 SELECT event_type, round(sum(value) + 1e-9, 2) AS amount, round(sum(value) / sum(sum(value)) OVER () + 1e-9, 6) AS share
 FROM g GROUP BY event_type""",
)
def eda_market_share_unknown(spark, sf_dir):
    events = event_log(spark, sf_dir)
    unknown = events.withColumn("value", F.expr("CASE WHEN event_id % 13 <> 0 THEN value ELSE double('NaN') END"))
    return rounded(explore.market_share(unknown, "event_type", "value"), 2, share=6)


@query(
    "mart_null_categories",
    """WITH p AS (SELECT CASE WHEN p_partkey % 6 <> 0 THEN p_brand END AS brand, p_size % 4 AS size, p_retailprice AS price FROM part)
 SELECT brand, CAST(size AS BIGINT) AS size, count(*) AS n, round(sum(price) + 1e-9, 2) AS total, round(avg(price) + 1e-9, 4) AS mean,
 round(min(price) + 1e-9, 4) AS low, CAST(grouping(brand) AS BIGINT) AS g_brand, CAST(grouping(size) AS BIGINT) AS g_size
 FROM p GROUP BY CUBE (brand, size)""",
)
def mart_null_categories(spark, sf_dir):
    brand = F.when(F.col("p_partkey") % 6 != 0, F.col("p_brand")).alias("brand")
    size = (F.col("p_size") % 4).cast("bigint").alias("size")
    parts = table(spark, sf_dir, "part").select(brand, size, F.col("p_retailprice").alias("price"))
    wanted = {"n": ("count", F.lit(1)), "total": ("sum", "price"), "mean": ("avg", "price"), "low": ("min", "price")}
    return rounded(marts.mart(parts, ["brand", "size"], wanted), total=2)


@query(
    "pm_arpau_exact",
    f"""SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS period, count(DISTINCT o_custkey) AS active,
 CAST(sum({LARGE} + CAST(o_orderkey AS HUGEINT)) - count(*) * CAST({LARGE} AS HUGEINT) AS BIGINT) AS above
 FROM orders GROUP BY 1""",
)
def pm_arpau_exact(spark, sf_dir):
    """Money in decimals, each amount beyond 2^53: the sums must lose nothing."""
    amount = (F.lit(LARGE) + F.col("order_id")).cast("decimal(20,0)")
    years = metrics.revenue_per_user(order_log(spark, sf_dir), "user_id", "ts", amount, "year")
    orders = order_log(spark, sf_dir).groupBy(F.trunc("ts", "year").cast("date").alias("period")).agg(F.count("*").alias("n"))
    above = (F.col("revenue") - F.col("n").cast("decimal(20,0)") * F.lit(LARGE).cast("decimal(20,0)")).cast("bigint")
    return years.join(orders, "period").select("period", "active", above.alias("above"))
