"""Queries for product metrics, user paths and unit economics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from growthkit.operators import contribution, metrics, paths, unit_econ
from growthkit.plans.adapters import (
    COSTS_SQL,
    USERS_SQL,
    costs,
    event_log,
    event_revenue,
    order_log,
    table,
    user_dim,
)
from growthkit.plans.registry import query, rounded

STEPS = ["view", "click", "purchase"]
GAP = dt.timedelta(hours=6)
LAST_FULL_MONTH = dt.date(2001, 7, 31)
YEARS = ((dt.date(1999, 1, 1), dt.date(2000, 1, 1)), (dt.date(2000, 1, 1), dt.date(2001, 1, 1)))


def user_days(spark, sf_dir):
    return event_log(spark, sf_dir).withColumn("day", F.to_date("ts"))


@query(
    "pm_mau",
    f"""SELECT CAST(date_trunc('month', ts) AS DATE) AS period, platform, count(DISTINCT user_id) AS users
 FROM events JOIN {USERS_SQL} AS u USING (user_id) GROUP BY 1, 2""",
)
def pm_mau(spark, sf_dir):
    return metrics.active_users(
        event_log(spark, sf_dir), "user_id", "ts", "month", "platform", user_dim(spark, sf_dir)
    )


@query(
    "pm_dau",
    "SELECT CAST(ts AS DATE) AS period, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
)
def pm_dau(spark, sf_dir):
    return metrics.active_users(event_log(spark, sf_dir), "user_id", "ts", "day")


@query(
    "pm_wau",
    """SELECT CAST(date_trunc('week', ts) AS DATE) AS period, event_type, count(DISTINCT user_id) AS users
 FROM events GROUP BY 1, 2""",
)
def pm_wau(spark, sf_dir):
    return metrics.active_users(event_log(spark, sf_dir), "user_id", "ts", "week", "event_type")


@query(
    "pm_new_users",
    f"""WITH f AS (SELECT o_custkey AS user_id, min(o_orderdate) AS ts FROM orders GROUP BY o_custkey)
 SELECT CAST(date_trunc('month', ts) AS DATE) AS period, channel, count(*) AS new_users
 FROM f JOIN {USERS_SQL} AS u USING (user_id) GROUP BY 1, 2""",
)
def pm_new_users(spark, sf_dir):
    return metrics.new_users(order_log(spark, sf_dir), "user_id", "ts", user_dim(spark, sf_dir), "channel")


@query(
    "pm_retention",
    """WITH a AS (SELECT DISTINCT o_custkey AS u, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders),
 c AS (SELECT u, min(m) AS cohort FROM a GROUP BY u),
 n AS (SELECT cohort, (year(m) - year(cohort)) * 12 + month(m) - month(cohort) AS age, count(*) AS active
  FROM a JOIN c USING (u) GROUP BY 1, 2),
 s AS (SELECT cohort, active AS size, unnest(generate_series(0,
  (2001 - year(cohort)) * 12 + 7 - month(cohort))) AS age FROM n WHERE age = 0 AND cohort <= DATE '2001-07-01')
 SELECT cohort, age, size, coalesce(active, 0) AS active, round(coalesce(active, 0) / size + 1e-9, 4) AS rate
 FROM s LEFT JOIN n USING (cohort, age)""",
)
def pm_retention(spark, sf_dir):
    return rounded(
        metrics.retention(order_log(spark, sf_dir), "user_id", "ts", complete_through=LAST_FULL_MONTH)
    )


@query(
    "pm_retention_daily",
    """WITH a AS (SELECT DISTINCT user_id AS u, CAST(ts AS DATE) AS d FROM events),
 c AS (SELECT u, min(d) AS cohort FROM a GROUP BY u),
 n AS (SELECT cohort, date_diff('day', cohort, d) AS age, count(*) AS active FROM a JOIN c USING (u) GROUP BY 1, 2),
 s AS (SELECT cohort, active AS size, unnest(generate_series(0, least(14, date_diff('day', cohort,
  (SELECT max(d) FROM a))))) AS age FROM n WHERE age = 0)
 SELECT cohort, age, size, coalesce(active, 0) AS active, round(coalesce(active, 0) / size + 1e-9, 4) AS rate
 FROM s LEFT JOIN n USING (cohort, age)""",
)
def pm_retention_daily(spark, sf_dir):
    return rounded(metrics.retention(event_log(spark, sf_dir), "user_id", "ts", "day", max_age=14))


@query(
    "pm_progress",
    """SELECT count(*) AS sessions, round(avg(done / 5) + 1e-9, 6) AS avg_progress FROM
 (SELECT count(DISTINCT event_type) AS done FROM events GROUP BY user_id, CAST(ts AS DATE)) AS s""",
)
def pm_progress(spark, sf_dir):
    return rounded(metrics.avg_progress(user_days(spark, sf_dir), ["user_id", "day"], "event_type", 5), 6)


@query(
    "pm_session_progress",
    """WITH n AS (SELECT user_id, event_type, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM
  (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR
  THEN 0 ELSE 1 END AS fresh FROM events) AS e)
 SELECT count(*) AS sessions, round(avg(done / 5) + 1e-9, 6) AS avg_progress FROM
 (SELECT count(DISTINCT event_type) AS done FROM n GROUP BY user_id, no) AS s""",
)
def pm_session_progress(spark, sf_dir):
    visits = paths.sessionize(event_log(spark, sf_dir), "user_id", "ts", GAP)
    return rounded(metrics.avg_progress(visits, ["user_id", "session_no"], "event_type", 5), 6)


PER_DAY_SQL = """SELECT CAST(ts AS DATE) AS period, count(DISTINCT user_id) AS active,
 count(DISTINCT user_id) FILTER (event_type = 'purchase') AS payers,
 sum(value) FILTER (event_type = 'purchase') AS r FROM events GROUP BY 1"""


@query(
    "pm_arpau",
    f"""SELECT period, active, round(r + 1e-9, 2) AS revenue, round(r / active + 1e-9, 4) AS arpau
 FROM ({PER_DAY_SQL}) AS d""",
)
def pm_arpau(spark, sf_dir):
    out = metrics.arpau(event_log(spark, sf_dir), "user_id", "ts", event_revenue(), "day")
    return rounded(out, revenue=2)


@query(
    "pm_funnel",
    """WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_type FROM events),
 s1 AS (SELECT user_id, day, min(ts) AS t FROM e WHERE event_type = 'view' GROUP BY 1, 2),
 s2 AS (SELECT user_id, day, min(e.ts) AS t FROM e JOIN s1 USING (user_id, day)
  WHERE event_type = 'click' AND e.ts > s1.t GROUP BY 1, 2),
 s3 AS (SELECT user_id, day, min(e.ts) AS t FROM e JOIN s2 USING (user_id, day)
  WHERE event_type = 'purchase' AND e.ts > s2.t GROUP BY 1, 2),
 n AS (SELECT 1 AS step_no, 'view' AS step, count(*) AS n FROM s1 UNION ALL SELECT 2, 'click', count(*) FROM s2
  UNION ALL SELECT 3, 'purchase', count(*) FROM s3)
 SELECT CAST(step_no AS BIGINT) AS step_no, step, n,
 round(n / coalesce(lag(n) OVER (ORDER BY step_no), n) + 1e-9, 4) AS from_prev,
 round(n / first_value(n) OVER (ORDER BY step_no) + 1e-9, 4) AS from_first FROM n""",
)
def pm_funnel(spark, sf_dir):
    return rounded(paths.funnel(user_days(spark, sf_dir), STEPS, ["user_id", "day"], "ts", "event_type"))


@query(
    "pm_funnel_users",
    """WITH s1 AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'signup' GROUP BY 1),
 s2 AS (SELECT user_id, min(e.ts) AS t FROM events AS e JOIN s1 USING (user_id)
  WHERE event_type = 'view' AND e.ts > s1.t GROUP BY 1),
 s3 AS (SELECT user_id, min(e.ts) AS t FROM events AS e JOIN s2 USING (user_id)
  WHERE event_type = 'click' AND e.ts > s2.t GROUP BY 1),
 s4 AS (SELECT user_id, min(e.ts) AS t FROM events AS e JOIN s3 USING (user_id)
  WHERE event_type = 'purchase' AND e.ts > s3.t GROUP BY 1),
 n AS (SELECT 1 AS step_no, 'signup' AS step, count(*) AS n FROM s1
  UNION ALL SELECT 2, 'view', count(*) FROM s2 JOIN s1 USING (user_id) WHERE s2.t <= s1.t + INTERVAL 3 DAY
  UNION ALL SELECT 3, 'click', count(*) FROM s3 JOIN s1 USING (user_id) WHERE s3.t <= s1.t + INTERVAL 3 DAY
  UNION ALL SELECT 4, 'purchase', count(*) FROM s4 JOIN s1 USING (user_id) WHERE s4.t <= s1.t + INTERVAL 3 DAY)
 SELECT CAST(step_no AS BIGINT) AS step_no, step, n,
 round(n / coalesce(lag(n) OVER (ORDER BY step_no), n) + 1e-9, 4) AS from_prev,
 round(n / first_value(n) OVER (ORDER BY step_no) + 1e-9, 4) AS from_first FROM n""",
)
def pm_funnel_users(spark, sf_dir):
    return rounded(
        paths.funnel(
            event_log(spark, sf_dir),
            ["signup", "view", "click", "purchase"],
            "user_id",
            "ts",
            "event_type",
            within=dt.timedelta(days=3),
        )
    )


@query(
    "pm_funnel_by_dim",
    f"""WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_type FROM events),
 s1 AS (SELECT user_id, day, min(ts) AS t FROM e WHERE event_type = 'view' GROUP BY 1, 2),
 s2 AS (SELECT user_id, day, min(e.ts) AS t FROM e JOIN s1 USING (user_id, day)
  WHERE event_type = 'click' AND e.ts > s1.t GROUP BY 1, 2),
 s3 AS (SELECT user_id, day, min(e.ts) AS t FROM e JOIN s2 USING (user_id, day)
  WHERE event_type = 'purchase' AND e.ts > s2.t GROUP BY 1, 2),
 a AS (SELECT 1 AS step_no, 'view' AS step, user_id FROM s1 UNION ALL SELECT 2, 'click', user_id FROM s2
  UNION ALL SELECT 3, 'purchase', user_id FROM s3),
 n AS (SELECT platform, step_no, step, count(*) AS n FROM a JOIN {USERS_SQL} AS u USING (user_id) GROUP BY 1, 2, 3)
 SELECT platform, CAST(step_no AS BIGINT) AS step_no, step, n,
 round(n / coalesce(lag(n) OVER w, n) + 1e-9, 4) AS from_prev, round(n / first_value(n) OVER w + 1e-9, 4) AS from_first
 FROM n WINDOW w AS (PARTITION BY platform ORDER BY step_no)""",
)
def pm_funnel_by_dim(spark, sf_dir):
    return rounded(
        paths.funnel(
            user_days(spark, sf_dir),
            STEPS,
            ["user_id", "day"],
            "ts",
            "event_type",
            dims="platform",
            users=user_dim(spark, sf_dir),
            user="user_id",
        )
    )


@query(
    "pm_share_over",
    """SELECT count(*) AS users, count(*) FILTER (n > 10) AS over,
 round(avg(CAST(n > 10 AS INTEGER)) + 1e-9, 4) AS share
 FROM (SELECT count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY user_id) AS u""",
)
def pm_share_over(spark, sf_dir):
    return rounded(
        metrics.share_over(event_log(spark, sf_dir), "user_id", F.col("event_type") == "purchase", 10)
    )


@query(
    "pm_basket",
    """SELECT count(DISTINCT l_orderkey) AS orders, round(sum(l_extendedprice) / count(DISTINCT l_orderkey) + 1e-9, 4)
 AS avg_check, round(count(*) / count(DISTINCT l_orderkey) + 1e-9, 4) AS avg_items,
 round(avg(l_extendedprice) + 1e-9, 4) AS avg_item_price FROM lineitem""",
)
def pm_basket(spark, sf_dir):
    return rounded(metrics.basket(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_extendedprice"))


MONTHLY_SQL = """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, {dims}
 sum(o_totalprice) AS revenue, count(DISTINCT o_custkey) AS active FROM {source} GROUP BY ALL"""
TREND_SQL = """SELECT {dims} period, round(revenue + 1e-9, 2) AS revenue,
 round(CASE WHEN p = period - INTERVAL 1 MONTH THEN revenue_lag END + 1e-9, 2) AS revenue_prev,
 round(CASE WHEN p = period - INTERVAL 1 MONTH THEN (revenue - revenue_lag) / nullif(revenue_lag, 0) END + 1e-9, 4)
  AS revenue_change,
 active, CASE WHEN p = period - INTERVAL 1 MONTH THEN active_lag END AS active_prev,
 round(CASE WHEN p = period - INTERVAL 1 MONTH THEN (active - active_lag) / nullif(active_lag, 0) END + 1e-9, 4)
  AS active_change,
 period <= DATE '2001-07-31' AS complete
 FROM (SELECT *, lag(period) OVER w AS p, lag(revenue) OVER w AS revenue_lag, lag(active) OVER w AS active_lag
  FROM ({monthly}) AS m WINDOW w AS ({part} ORDER BY period)) AS t"""


@query(
    "pm_trend",
    TREND_SQL.format(dims="", part="", monthly=MONTHLY_SQL.format(dims="", source="orders")),
)
def pm_trend(spark, sf_dir):
    monthly = metrics.revenue_per_user(order_log(spark, sf_dir), "user_id", "ts", F.col("amount"))
    out = metrics.trend(monthly, ["revenue", "active"], complete_through=LAST_FULL_MONTH)
    return rounded(out, revenue=2, revenue_prev=2)


@query(
    "pm_contribution",
    f"""WITH s AS (SELECT platform, coalesce(sum(o_totalprice) FILTER (year(o_orderdate) = 1999), 0) AS before,
  coalesce(sum(o_totalprice) FILTER (year(o_orderdate) = 2000), 0) AS after
  FROM orders JOIN {USERS_SQL} AS u ON user_id = o_custkey
  WHERE year(o_orderdate) IN (1999, 2000) GROUP BY platform)
 SELECT platform, round(before + 1e-9, 2) AS before, round(after + 1e-9, 2) AS after,
 round(after - before + 1e-9, 2) AS change, round((after - before) / sum(after - before) OVER () + 1e-9, 4) AS share
 FROM s""",
)
def pm_contribution(spark, sf_dir):
    out = contribution.contribution(
        order_log(spark, sf_dir), "user_id", "ts", F.col("amount"), *YEARS, "platform", user_dim(spark, sf_dir)
    )
    return rounded(out, 2, share=4)


@query(
    "pm_decompose",
    """WITH o AS (SELECT o_custkey, year(o_orderdate) AS y, CASE WHEN o_totalprice > 400000 THEN o_totalprice END AS v
  FROM orders WHERE year(o_orderdate) IN (1999, 2000)),
 a AS (SELECT y, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS u,
  CAST(count(DISTINCT o_custkey) FILTER (v IS NOT NULL) AS DOUBLE) AS p, sum(v) AS r FROM o GROUP BY y),
 x AS (SELECT b.u AS u0, c.u AS u1, b.p / b.u AS s0, c.p / c.u AS s1, b.r / b.p AS a0, c.r / c.p AS a1,
  b.r AS r0, c.r AS r1, (c.r - b.r) / ln(c.r / b.r) AS l FROM a AS b, a AS c WHERE b.y = 1999 AND c.y = 2000)
 SELECT 'audience' AS factor, round(u0 + 1e-9, 4) AS before, round(u1 + 1e-9, 4) AS after,
  round(l * ln(u1 / u0) + 1e-9, 2) AS effect FROM x
 UNION ALL SELECT 'payer_share', round(s0 + 1e-9, 4), round(s1 + 1e-9, 4), round(l * ln(s1 / s0) + 1e-9, 2) FROM x
 UNION ALL SELECT 'arppu', round(a0 + 1e-9, 4), round(a1 + 1e-9, 4), round(l * ln(a1 / a0) + 1e-9, 2) FROM x
 UNION ALL SELECT 'revenue', round(r0 + 1e-9, 4), round(r1 + 1e-9, 4), round(r1 - r0 + 1e-9, 2) FROM x""",
)
def pm_decompose(spark, sf_dir):
    revenue = F.when(F.col("amount") > 400000, F.col("amount"))
    return rounded(contribution.decompose(order_log(spark, sf_dir), "user_id", "ts", revenue, *YEARS), effect=2)


@query(
    "pm_transitions",
    """WITH m AS (SELECT event_type AS f, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS t
  FROM events)
 SELECT f AS "from", t AS "to", count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY f) + 1e-9, 4) AS share
 FROM m WHERE t IS NOT NULL GROUP BY f, t""",
)
def pm_transitions(spark, sf_dir):
    return rounded(paths.transitions(event_log(spark, sf_dir), "user_id", "ts", "event_type", "event_id"))


SESSION_SQL = """SELECT event_id, user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no
 FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR
 THEN 0 ELSE 1 END AS s FROM events) AS e"""


@query(
    "pm_sessions",
    f"""SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS started, max(ts) AS ended,
 count(*) AS n_events, date_sub('second', min(ts), max(ts)) AS seconds FROM ({SESSION_SQL}) AS s GROUP BY 1, 2""",
)
def pm_sessions(spark, sf_dir):
    return paths.sessions(event_log(spark, sf_dir), "user_id", "ts", GAP)


@query("pm_sessionize", f"SELECT event_id, CAST(session_no AS BIGINT) AS session_no FROM ({SESSION_SQL}) AS s")
def pm_sessionize(spark, sf_dir):
    events = event_log(spark, sf_dir).select("event_id", "user_id", "ts")
    return paths.sessionize(events, "user_id", "ts", GAP).select("event_id", "session_no")


LTV_SQL = f"""WITH f AS (SELECT user_id, CAST(min(ts) AS DATE) AS d0 FROM events GROUP BY user_id
  HAVING CAST(min(ts) AS DATE) + 27 <= (SELECT CAST(max(ts) AS DATE) FROM events)),
 u AS (SELECT user_id, d0, channel FROM f JOIN {USERS_SQL} AS x USING (user_id)),
 n AS (SELECT channel, count(*) AS users, unnest(generate_series(0, 27)) AS age FROM u GROUP BY channel),
 r AS (SELECT channel, date_diff('day', d0, CAST(ts AS DATE)) AS age, sum(value) AS v
  FROM events JOIN u USING (user_id) WHERE event_type = 'purchase' GROUP BY 1, 2),
 ltv AS (SELECT channel, age, users, sum(coalesce(v, 0)) OVER (PARTITION BY channel ORDER BY age) AS revenue
  FROM n LEFT JOIN r USING (channel, age)),
 roi AS (SELECT channel, age, users, revenue / users AS ltv, cost / users AS cac,
  (revenue / users - cost / users) / (cost / users) AS roi FROM ltv JOIN {COSTS_SQL} USING (channel))"""


def _ltv(spark, sf_dir):
    return unit_econ.ltv_curve(
        event_log(spark, sf_dir), "user_id", "ts", event_revenue(), user_dim(spark, sf_dir), "channel", 28
    )


def _roi(spark, sf_dir):
    return unit_econ.roi_curve(_ltv(spark, sf_dir), costs(spark), "channel")


@query(
    "ue_ltv_curve",
    LTV_SQL
    + """ SELECT channel, age, users, round(revenue + 1e-9, 2) AS revenue,
 round(revenue / users + 1e-9, 4) AS ltv FROM ltv""",
)
def ue_ltv_curve(spark, sf_dir):
    return rounded(_ltv(spark, sf_dir).drop("acquired"), revenue=2)


@query(
    "ue_cac",
    f"""SELECT channel, count(user_id) AS users, max(cost) AS cost, round(max(cost) / count(user_id) + 1e-9, 4) AS cac
 FROM {COSTS_SQL} JOIN (SELECT DISTINCT user_id, channel FROM events JOIN {USERS_SQL} AS x USING (user_id)) AS u
 USING (channel) GROUP BY channel""",
)
def ue_cac(spark, sf_dir):
    acquired = event_log(spark, sf_dir).select("user_id").distinct().join(user_dim(spark, sf_dir), "user_id")
    return rounded(unit_econ.cac(acquired, costs(spark), "channel"))


@query(
    "ue_roi",
    LTV_SQL
    + """ SELECT channel, age, users, round(ltv + 1e-9, 4) AS ltv, round(cac + 1e-9, 4) AS cac,
 round(roi + 1e-9, 4) AS roi FROM roi""",
)
def ue_roi(spark, sf_dir):
    return rounded(_roi(spark, sf_dir))


@query(
    "ue_payback",
    LTV_SQL
    + """ SELECT channel, min(age) FILTER (roi >= 0) AS payback_age, max(roi) >= 0 AS paid_back,
 round(max(roi) FILTER (age = 27) + 1e-9, 4) AS last_roi FROM roi GROUP BY channel""",
)
def ue_payback(spark, sf_dir):
    return rounded(unit_econ.payback(_roi(spark, sf_dir), "channel"))


@query(
    "ue_arppu",
    f"""SELECT period, payers, round(r + 1e-9, 2) AS revenue, round(r / nullif(payers, 0) + 1e-9, 4) AS arppu
 FROM ({PER_DAY_SQL}) AS d""",
)
def ue_arppu(spark, sf_dir):
    out = unit_econ.arppu(event_log(spark, sf_dir), "user_id", "ts", event_revenue(), "day")
    return rounded(out, revenue=2)


@query(
    "ue_trend_by_channel",
    TREND_SQL.format(
        dims="channel,",
        part="PARTITION BY channel",
        monthly=MONTHLY_SQL.format(
            dims="channel,", source=f"orders JOIN {USERS_SQL} AS u ON user_id = o_custkey"
        ),
    ),
)
def ue_trend_by_channel(spark, sf_dir):
    out = unit_econ.trend_by_source(
        order_log(spark, sf_dir),
        "user_id",
        "ts",
        F.col("amount"),
        "channel",
        user_dim(spark, sf_dir),
        complete_through=LAST_FULL_MONTH,
    )
    return rounded(out, revenue=2, revenue_prev=2)


@query(
    "ue_contribution_by_channel",
    f"""WITH s AS (SELECT channel, coalesce(sum(o_totalprice) FILTER (year(o_orderdate) = 1999), 0) AS before,
  coalesce(sum(o_totalprice) FILTER (year(o_orderdate) = 2000), 0) AS after
  FROM orders JOIN {USERS_SQL} AS u ON user_id = o_custkey
  WHERE year(o_orderdate) IN (1999, 2000) GROUP BY channel)
 SELECT channel, round(before + 1e-9, 2) AS before, round(after + 1e-9, 2) AS after,
 round(after - before + 1e-9, 2) AS change, round((after - before) / sum(after - before) OVER () + 1e-9, 4) AS share
 FROM s""",
)
def ue_contribution_by_channel(spark, sf_dir):
    out = contribution.contribution(
        order_log(spark, sf_dir), "user_id", "ts", F.col("amount"), *YEARS, "channel", user_dim(spark, sf_dir)
    )
    return rounded(out, 2, share=4)
