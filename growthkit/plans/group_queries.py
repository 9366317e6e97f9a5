"""Queries for segmentation and experiments."""

from __future__ import annotations

import datetime as dt
from statistics import NormalDist

from pyspark.sql import functions as F

from growthkit.operators import experiments, listings, metrics, paths, segments
from growthkit.operators.prepare import flag_exists
from growthkit.plans.adapters import USERS_SQL, event_log, order_log, table, user_dim
from growthkit.plans.explore_queries import orders_by_user
from growthkit.plans.registry import query, rounded
from growthkit.sources.tables import load_tables

AS_OF = dt.date(2001, 8, 2)

RFM_SQL = """WITH u AS (SELECT o_custkey AS user_id, date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-02')
  AS r_days, count(*) AS freq, sum(o_totalprice) AS monetary FROM orders GROUP BY o_custkey),
 q AS (SELECT quantile_cont(r_days, [0.2, 0.4, 0.6, 0.8]) AS r, quantile_cont(freq, [0.2, 0.4, 0.6, 0.8]) AS f,
  quantile_cont(monetary, [0.2, 0.4, 0.6, 0.8]) AS m FROM u),
 rfm AS (SELECT user_id, r_days, freq, monetary,
  CAST(5 - len(list_filter(q.r, lambda x: r_days > x)) AS BIGINT) AS r,
  CAST(1 + len(list_filter(q.f, lambda x: freq > x)) AS BIGINT) AS f,
  CAST(1 + len(list_filter(q.m, lambda x: monetary > x)) AS BIGINT) AS m FROM u, q)"""


@query(
    "seg_rfm",
    RFM_SQL + " SELECT user_id, r_days, freq, round(monetary + 1e-9, 2) AS monetary, r, f, m FROM rfm",
)
def seg_rfm(spark, sf_dir):
    return rounded(segments.rfm(order_log(spark, sf_dir), "user_id", "ts", "amount", AS_OF), 2)


@query(
    "seg_rfm_summary",
    RFM_SQL
    + """ SELECT r, f, m, count(*) AS customers, round(sum(monetary) + 1e-9, 2) AS revenue,
 round(count(*) / sum(count(*)) OVER () + 1e-9, 4) AS customer_share,
 round(sum(monetary) / sum(sum(monetary)) OVER () + 1e-9, 4) AS revenue_share FROM rfm GROUP BY r, f, m""",
)
def seg_rfm_summary(spark, sf_dir):
    scores = segments.rfm(order_log(spark, sf_dir), "user_id", "ts", "amount", AS_OF)
    return rounded(segments.rfm_summary(scores), revenue=2)


FEATURES = ["lines", "price", "discount", "returned"]


def supplier_features(spark, sf_dir):
    """Suppliers stand for restaurants: order lines, net price, discount and returns of each."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("supplier"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("lines"),
            F.avg(net).alias("price"),
            F.avg("l_discount").alias("discount"),
            F.avg((F.col("l_returnflag") == "R").cast("double")).alias("returned"),
        )
    )


AXES = ["x1", "x2", "x3", "x4"]


def kmeans_sql(fits: list[tuple[int, int]]) -> str:
    """K-Means over suppliers for (k, seed) pairs, ending in points `p` and labels `near(k, seed, id, c, dist)`."""
    gap = " + ".join(f"pow(p.{x} - it.{x}, 2)" for x in AXES)
    scaled = ", ".join(
        f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {x}" for x, c in zip(AXES, FEATURES)
    )
    means = ", ".join(f"avg(p.{x})" for x in AXES)
    return f"""WITH RECURSIVE f AS (SELECT l_suppkey AS supplier, CAST(count(*) AS DOUBLE) AS lines,
  avg(l_extendedprice * (1 - l_discount)) AS price, avg(l_discount) AS discount,
  avg(CAST(l_returnflag = 'R' AS DOUBLE)) AS returned FROM lineitem GROUP BY l_suppkey),
 p AS (SELECT supplier AS id, {scaled} FROM f),
 fits(k, seed) AS (VALUES {", ".join(map(str, fits))}),
 it AS (SELECT 0 AS i, k, seed, c, x1, x2, x3, x4 FROM (SELECT k, seed, x1, x2, x3, x4,
   row_number() OVER (PARTITION BY k, seed ORDER BY md5(seed || ':' || id)) - 1 AS c FROM p, fits) AS o WHERE c < k
  UNION ALL SELECT i + 1, k, seed, n.c, {means} FROM
   (SELECT it.i, it.k, it.seed, p.id, arg_min(it.c, {gap}) AS c
    FROM it, p WHERE it.i < 100 GROUP BY it.i, it.k, it.seed, p.id) AS n
   JOIN p ON p.id = n.id GROUP BY i, k, seed, n.c),
 near AS (SELECT k, seed, p.id, arg_min(it.c, {gap}) AS c,
   min({gap}) AS dist
  FROM it, p WHERE it.i = 100 GROUP BY k, seed, p.id)"""


LABELS_SQL = (
    kmeans_sql([(3, 1), (3, 2), (3, 3)])
    + """, best AS (SELECT seed FROM near GROUP BY seed ORDER BY sum(dist) LIMIT 1),
 place AS (SELECT c, row_number() OVER (ORDER BY x1, x2, x3, x4) - 1 AS cluster
  FROM it JOIN best USING (seed) WHERE i = 100),
 label AS (SELECT id AS supplier, CAST(cluster AS BIGINT) AS cluster
  FROM near JOIN best USING (seed) JOIN place USING (c))"""
)


@query("seg_kmeans", LABELS_SQL + " SELECT supplier, cluster FROM label")
def seg_kmeans(spark, sf_dir):
    return segments.kmeans(supplier_features(spark, sf_dir), "supplier", FEATURES, 3, tol=1e-9)


@query(
    "seg_choose_k",
    kmeans_sql([(k, 1) for k in (2, 3, 4, 5)])
    + """, size AS (SELECT k, n.c, count(*) AS n, sum(x1 * x1 + x2 * x2 + x3 * x3 + x4 * x4) AS psi,
  sum(x1) AS x1, sum(x2) AS x2, sum(x3) AS x3, sum(x4) AS x4 FROM near AS n JOIN p ON p.id = n.id GROUP BY k, n.c),
 away AS (SELECT n.k, n.id, n.c = s.c AS own, s.n, p.x1 * p.x1 + p.x2 * p.x2 + p.x3 * p.x3 + p.x4 * p.x4 + s.psi / s.n
  - 2 * (p.x1 * s.x1 + p.x2 * s.x2 + p.x3 * s.x3 + p.x4 * s.x4) / s.n AS dist
  FROM near AS n JOIN p ON p.id = n.id JOIN size AS s ON s.k = n.k),
 ab AS (SELECT k, id, max(CASE WHEN n > 1 THEN dist * n / (n - 1) END) FILTER (own) AS a,
  min(dist) FILTER (NOT own) AS b FROM away GROUP BY k, id),
 sil AS (SELECT k, avg(coalesce((b - a) / greatest(a, b), 0)) AS silhouette FROM ab GROUP BY k)
 SELECT CAST(k AS BIGINT) AS k, round(cost + 1e-9, 4) AS cost, round(silhouette + 1e-9, 4) AS silhouette,
 true AS converged
 FROM (SELECT k, sum(dist) AS cost FROM near GROUP BY k) AS c JOIN sil USING (k)""",
)
def seg_choose_k(spark, sf_dir):
    features = supplier_features(spark, sf_dir)
    return rounded(segments.choose_k(features, "supplier", FEATURES, [2, 3, 4, 5], seeds=1, tol=1e-9))


@query(
    "seg_cluster_profile",
    LABELS_SQL
    + """ SELECT cluster, count(*) AS n, round(avg(lines) + 1e-9, 4) AS lines, round(avg(price) + 1e-9, 4) AS price,
 round(avg(discount) + 1e-9, 4) AS discount, round(avg(returned) + 1e-9, 4) AS returned
 FROM label JOIN f USING (supplier) GROUP BY cluster""",
)
def seg_cluster_profile(spark, sf_dir):
    features = supplier_features(spark, sf_dir)
    labelled = segments.kmeans(features, "supplier", FEATURES, 3, tol=1e-9, with_input=True)
    return rounded(segments.cluster_profile(labelled, "cluster", FEATURES))


# Probabilities in SQL, from series with positive terms: normal tail, Student t, chi-square.
def normal_sf_sql(z: str) -> str:
    """P(Z > z)."""
    series = (
        f"list_sum(list_transform(generate_series(0, 200), lambda i: exp((2 * i + 1) * ln(abs({z}))"
        " - ((i + 1) * ln(2) + lgamma(i + 1.5) - 0.5 * ln(pi())))))"
    )
    return f"(0.5 - sign({z}) * exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * {series})"


def t_tails_sql(t: str, df: str) -> str:
    """P(|T| > t)."""
    y = f"(({t}) * ({t}) / (({df}) + ({t}) * ({t})))"
    b = f"(({df}) / 2)"
    series = (
        f"list_sum(list_transform(generate_series(0, 2000), lambda i: exp(lgamma(0.5 + {b} + i) - lgamma(0.5 + {b})"
        f" - lgamma(1.5 + i) + lgamma(1.5) + i * ln({y}))))"
    )
    front = f"exp(0.5 * ln({y}) + {b} * ln(1 - {y}) + lgamma(0.5 + {b}) - lgamma(0.5) - lgamma({b})) / 0.5"
    return f"(1 - {front} * {series})"


def chi2_sf_sql(x: str, df: str) -> str:
    """P(X > x)."""
    a, y = f"(({df}) / 2)", f"(({x}) / 2)"
    series = (
        f"list_sum(list_transform(generate_series(0, 400), lambda i: exp(lgamma({a} + 1) - lgamma({a} + 1 + i)"
        f" + i * ln({y}))))"
    )
    return f"(1 - exp({a} * ln({y}) - {y} - lgamma({a} + 1)) * {series})"


def t_critical_sql(p: float, df: str) -> str:
    """Quantile of Student t from the normal one; the expansion is exact enough for df above 100."""
    z = NormalDist().inv_cdf(p)
    g1 = (z**3 + z) / 4
    g2 = (5 * z**5 + 16 * z**3 + 3 * z) / 96
    g3 = (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384
    g4 = (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160
    return f"({z!r} + {g1!r} / ({df}) + {g2!r} / ({df})**2 + {g3!r} / ({df})**3 + {g4!r} / ({df})**4)"


Z_DESIGN = NormalDist().inv_cdf(0.975) + NormalDist().inv_cdf(0.8)
DESIGN_MDE = 0.02


def design_sql(log: str) -> str:
    """Every length of a test with its users counted from scratch, and the shortest that is long enough."""
    return f"""WITH l AS ({log}), d AS (SELECT DISTINCT day FROM l), s AS (SELECT min(day) AS s FROM l),
 b AS (SELECT day, u, max(ok) AS ok FROM (SELECT d.day, l.u, l.ok FROM d JOIN l ON l.day <= d.day) AS x GROUP BY 1, 2),
 r AS (SELECT day, count(*) AS reach, avg(CAST(ok AS INTEGER)) AS p FROM b GROUP BY day),
 n AS (SELECT date_diff('day', s, day) + 1 AS days, reach, p,
  CASE WHEN p > 0 AND p + {DESIGN_MDE} < 1 THEN ceil({Z_DESIGN * Z_DESIGN / (DESIGN_MDE * DESIGN_MDE)!r}
   * (p * (1 - p) + (p + {DESIGN_MDE}) * (1 - p - {DESIGN_MDE}))) END AS n FROM r, s),
 pick AS (SELECT p, n, CASE WHEN reach >= 2 * n THEN days END AS days FROM n
  ORDER BY coalesce(reach >= 2 * n, false) DESC, CASE WHEN reach >= 2 * n THEN days ELSE -days END LIMIT 1)
 SELECT round(p + 1e-9, 4) AS baseline, (SELECT round(avg(c) + 1e-9, 4) FROM
  (SELECT count(DISTINCT u) AS c FROM l GROUP BY day) AS x) AS daily_users,
 CAST(n AS BIGINT) AS n_per_group, CAST(days AS BIGINT) AS days FROM pick"""


@query(
    "ab_design",
    design_sql("SELECT CAST(o_orderdate AS DATE) AS day, o_custkey AS u, o_totalprice > 400000 AS ok FROM orders"),
)
def ab_design(spark, sf_dir):
    daily = order_log(spark, sf_dir).withColumn("big", F.col("amount") > 400000)
    return rounded(experiments.ab_design(daily, "user_id", "ts", "big", DESIGN_MDE))


@query(
    "ab_design_unreachable",
    design_sql("SELECT CAST(ts AS DATE) AS day, user_id AS u, event_type = 'purchase' AND value > 160 AS ok FROM events"),
)
def ab_design_unreachable(spark, sf_dir):
    # The log holds far fewer users than the test needs, so there is no number of days.
    daily = event_log(spark, sf_dir).withColumn("ok", (F.col("event_type") == "purchase") & (F.col("value") > 160))
    return rounded(experiments.ab_design(daily, "user_id", "ts", "ok", DESIGN_MDE))


@query(
    "ab_assign",
    """SELECT c_custkey, CASE WHEN place < 0.5 THEN 'control' WHEN place < 0.8 THEN 'b' ELSE 'c' END AS "group" FROM
 (SELECT c_custkey, CAST('0x' || substr(md5('spring:' || CAST(c_custkey AS VARCHAR)), 1, 12) AS BIGINT) / pow(2, 48) AS place
 FROM customer) AS s""",
)
def ab_assign(spark, sf_dir):
    users = table(spark, sf_dir, "customer").select("c_custkey")
    return experiments.assign(users, "c_custkey", "spring", {"control": 0.5, "b": 0.3, "c": 0.2})


@query(
    "ab_prepare",
    f"""WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2)
 SELECT user_id, channel, CAST(sum(date_sub('second', a, b)) AS BIGINT) AS seconds, count(*) AS n_sessions
 FROM s JOIN {USERS_SQL} AS u USING (user_id) WHERE channel IN ('ASIA', 'EUROPE') GROUP BY 1, 2""",
)
def ab_prepare(spark, sf_dir):
    # A user's day stands for a session, the region for the city.
    days = (
        event_log(spark, sf_dir)
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.min("ts").alias("started"), F.max("ts").alias("ended"))
        .join(user_dim(spark, sf_dir), "user_id")
    )
    return experiments.ab_prepare(days, "user_id", "channel", "started", "ended", ["ASIA", "EUROPE"])


@query(
    "ab_prepare_sessions",
    f"""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR
  THEN 0 ELSE 1 END AS fresh FROM events),
 n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g),
 s AS (SELECT user_id, no, date_sub('second', min(ts), max(ts)) AS sec FROM n GROUP BY 1, 2)
 SELECT user_id, channel, CAST(sum(sec) AS BIGINT) AS seconds, count(*) AS n_sessions
 FROM s JOIN {USERS_SQL} AS u USING (user_id) GROUP BY 1, 2""",
)
def ab_prepare_sessions(spark, sf_dir):
    visits = paths.sessions(event_log(spark, sf_dir), "user_id", "ts", dt.timedelta(hours=6))
    placed = visits.join(user_dim(spark, sf_dir), "user_id")
    return experiments.ab_prepare(placed, "user_id", "channel", "started", "ended")


@query(
    "ab_history",
    """WITH g AS (SELECT c_custkey AS u, CASE WHEN
  CAST('0x' || substr(md5('spring:' || CAST(c_custkey AS VARCHAR)), 1, 12) AS BIGINT) < pow(2, 47)
  THEN 'a' ELSE 'b' END AS grp FROM customer)
 SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period, grp, count(DISTINCT o_custkey) AS active,
 round(sum(o_totalprice) + 1e-9, 2) AS revenue, round(sum(o_totalprice) / count(DISTINCT o_custkey) + 1e-9, 2) AS arpau
 FROM orders JOIN g ON u = o_custkey GROUP BY 1, 2""",
)
def ab_history(spark, sf_dir):
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    groups = experiments.assign(users, "user_id", "spring", {"a": 1, "b": 1}, name="grp")
    out = metrics.arpau(order_log(spark, sf_dir), "user_id", "ts", F.col("amount"), "quarter", "grp", groups)
    return rounded(out, 2)


@query(
    "ab_overlap",
    """SELECT user_id, count(DISTINCT event_type) AS n_groups FROM events GROUP BY user_id
 HAVING count(DISTINCT event_type) > 1""",
)
def ab_overlap(spark, sf_dir):
    return experiments.overlap(event_log(spark, sf_dir), "user_id", "event_type")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "ab_srm",
    f"""WITH c AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment),
 x AS (SELECT CAST(sum(n) AS BIGINT) AS n, sum((n - t / 5) * (n - t / 5) / (t / 5)) AS chi2
  FROM (SELECT n, sum(n) OVER () AS t FROM c) AS y)
 SELECT n, CAST(5 AS BIGINT) AS groups, CAST(0 AS BIGINT) AS unplanned, round(chi2 + 1e-9, 6) AS chi2,
 round({chi2_sf_sql("chi2", "4.0")} + 1e-9, 6) AS p FROM x""",
)
def ab_srm(spark, sf_dir):
    users = table(spark, sf_dir, "customer")
    return rounded(experiments.srm(users, "c_mktsegment", dict.fromkeys(SEGMENTS, 1.0), "c_custkey"), 6)


@query(
    "ab_srm_pair",
    f"""WITH x AS (SELECT count(*) AS n, pow(count(*) FILTER (c_mktsegment = 'AUTOMOBILE') - count(*) / 2, 2)
  / (count(*) / 2) * 2 AS chi2 FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING'))
 SELECT n, CAST(2 AS BIGINT) AS groups,
 (SELECT count(*) FROM customer WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')) AS unplanned, round(chi2 + 1e-9, 6) AS chi2,
 round(2 * {normal_sf_sql("sqrt(chi2)")} + 1e-9, 6) AS p FROM x""",
)
def ab_srm_pair(spark, sf_dir):
    users = table(spark, sf_dir, "customer")
    return rounded(experiments.srm(users, "c_mktsegment", {"AUTOMOBILE": 0.5, "BUILDING": 0.5}), 6)


def _by_parity(spark, sf_dir):
    """Customers in two groups by an even or odd key."""
    even = F.col("c_custkey") % 2 == 0
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(even, F.lit("a")).otherwise(F.lit("b")).alias("grp"),
        "c_acctbal",
        (F.col("c_acctbal") > 5000).alias("rich"),
    )


def welch_sql(source: str, p: str, margin_level: float, low: str, high: str) -> str:
    """Welch's test over `source(metric, x, b)`, `b` true for the second group."""
    return f"""WITH s AS ({source}),
 g AS (SELECT metric, count(x) FILTER (NOT b) AS n_a, count(x) FILTER (b) AS n_b, avg(x) FILTER (NOT b) AS mean_a,
  avg(x) FILTER (b) AS mean_b, var_samp(x) FILTER (NOT b) / count(x) FILTER (NOT b) AS va,
  var_samp(x) FILTER (b) / count(x) FILTER (b) AS vb FROM s GROUP BY metric),
 w AS (SELECT *, mean_b - mean_a AS diff, (mean_b - mean_a) / sqrt(va + vb) AS t,
  pow(va + vb, 2) / (va * va / (n_a - 1) + vb * vb / (n_b - 1)) AS df FROM g),
 v AS (SELECT *, {t_critical_sql(margin_level, "df")} * sqrt(va + vb) AS margin,
  {t_tails_sql("t", "df")} AS tails FROM w),
 tested AS (SELECT metric, n_a, n_b, mean_a, mean_b, diff, t, df, {p} AS p, {low} AS ci_lo, {high} AS ci_hi FROM v)"""


WELCH_OUT = """ SELECT n_a, n_b, round(mean_a + 1e-9, 4) AS mean_a, round(mean_b + 1e-9, 4) AS mean_b,
 round(diff + 1e-9, 4) AS diff, round(t + 1e-9, 6) AS t, round(df + 1e-9, 4) AS df, round(p + 1e-9, 6) AS p,
 round(ci_lo + 1e-9, 4) AS ci_lo, round(ci_hi + 1e-9, 4) AS ci_hi FROM tested"""


@query(
    "ab_welch",
    welch_sql(
        "SELECT 'x' AS metric, c_acctbal AS x, c_custkey % 2 = 1 AS b FROM customer",
        "tails",
        0.975,
        "diff - margin",
        "diff + margin",
    )
    + WELCH_OUT,
)
def ab_welch(spark, sf_dir):
    out = experiments.welch(_by_parity(spark, sf_dir), "grp", "c_acctbal", "a", "b", user="user_id")
    return rounded(out, 4, t=6, p=6)


ZTEST_SQL = f"""WITH s AS (SELECT c_acctbal > 5000 AS x, c_custkey % 2 = 1 AS b FROM customer),
 g AS (SELECT count(*) FILTER (NOT b) AS n_a, count(*) FILTER (b) AS n_b,
  count(*) FILTER (x AND NOT b) / count(*) FILTER (NOT b) AS rate_a,
  count(*) FILTER (x AND b) / count(*) FILTER (b) AS rate_b, count(*) FILTER (x) / count(*) AS r FROM s),
 z AS (SELECT *, rate_b - rate_a AS diff, (rate_b - rate_a) / sqrt(r * (1 - r) * (1 / n_a + 1 / n_b)) AS z,
  {NormalDist().inv_cdf(0.975)!r} * sqrt(rate_a * (1 - rate_a) / n_a + rate_b * (1 - rate_b) / n_b) AS margin FROM g)"""


@query(
    "ab_ztest",
    ZTEST_SQL
    + f""" SELECT n_a, n_b, round(rate_a + 1e-9, 6) AS rate_a, round(rate_b + 1e-9, 6) AS rate_b,
 round(diff + 1e-9, 6) AS diff, round(z + 1e-9, 6) AS z, round(2 * {normal_sf_sql("abs(z)")} + 1e-9, 6) AS p,
 round(diff - margin + 1e-9, 6) AS ci_lo, round(diff + margin + 1e-9, 6) AS ci_hi FROM z""",
)
def ab_ztest(spark, sf_dir):
    return rounded(experiments.ztest(_by_parity(spark, sf_dir), "grp", "rich", "a", "b", user="user_id"), 6)


def _plans(spark, sf_dir):
    """Customers by plan (BUILDING stands for subscribed) with their orders and spend."""
    users = listings.two_way(
        table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING", rest="free", name="plan"
    ).select(F.col("c_custkey").alias("user_id"), "plan")
    return users.join(orders_by_user(spark, sf_dir), "user_id", "left").fillna({"orders": 0, "amount": 0.0})


PLANS_SQL = """SELECT {metric} AS metric, {x} AS x, c_mktsegment = 'BUILDING' AS b FROM customer LEFT JOIN
 (SELECT o_custkey, count(*) AS orders, sum(o_totalprice) AS amount FROM orders GROUP BY o_custkey) AS o
 ON o_custkey = c_custkey"""


@query(
    "hyp_one_sided",
    welch_sql(
        PLANS_SQL.format(metric="'x'", x="coalesce(orders, 0)"),
        "CASE WHEN t > 0 THEN tails / 2 ELSE 1 - tails / 2 END",
        0.95,
        "diff - margin",
        "CAST('inf' AS DOUBLE)",
    )
    + WELCH_OUT.replace(", round(ci_hi + 1e-9, 4) AS ci_hi", ""),
)
def hyp_one_sided(spark, sf_dir):
    out = experiments.welch(_plans(spark, sf_dir), "plan", "orders", "free", "BUILDING", "greater")
    return rounded(out.drop("ci_hi"), 4, t=6, p=6)


@query(
    "hyp_one_sided_rate",
    f"""WITH c AS (SELECT c_mktsegment = 'BUILDING' AS b,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS x FROM customer),
 g AS (SELECT count(*) FILTER (NOT b) AS n_a, count(*) FILTER (b) AS n_b,
  count(*) FILTER (x AND NOT b) / count(*) FILTER (NOT b) AS rate_a,
  count(*) FILTER (x AND b) / count(*) FILTER (b) AS rate_b, count(*) FILTER (x) / count(*) AS r FROM c),
 z AS (SELECT *, rate_b - rate_a AS diff, (rate_b - rate_a) / sqrt(r * (1 - r) * (1 / n_a + 1 / n_b)) AS z,
  {NormalDist().inv_cdf(0.95)!r} * sqrt(rate_a * (1 - rate_a) / n_a + rate_b * (1 - rate_b) / n_b) AS margin FROM g)
 SELECT n_a, n_b, round(rate_a + 1e-9, 6) AS rate_a, round(rate_b + 1e-9, 6) AS rate_b,
 round(diff + 1e-9, 6) AS diff, round(z + 1e-9, 6) AS z, round({normal_sf_sql("z")} + 1e-9, 6) AS p,
 round(diff - margin + 1e-9, 6) AS ci_lo FROM z""",
)
def hyp_one_sided_rate(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["customer", "orders"])
    users = listings.two_way(t["customer"], "c_mktsegment", "BUILDING", rest="free", name="plan")
    payers = t["orders"].where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    flagged = flag_exists(users.select("c_custkey", "plan"), payers, "c_custkey", "payer")
    out = experiments.ztest(flagged, "plan", "payer", "free", "BUILDING", "greater")
    return rounded(out.drop("ci_hi"), 6)


@query(
    "ab_report",
    welch_sql(
        PLANS_SQL.format(metric="'orders'", x="coalesce(orders, 0)")
        + " UNION ALL "
        + PLANS_SQL.format(metric="'amount'", x="coalesce(amount, 0)"),
        "tails",
        0.975,
        "diff - margin",
        "diff + margin",
    )
    + f""", c AS (SELECT c_mktsegment = 'BUILDING' AS b,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS x FROM customer),
 g2 AS (SELECT count(*) FILTER (NOT b) AS n_a, count(*) FILTER (b) AS n_b,
  count(*) FILTER (x AND NOT b) / count(*) FILTER (NOT b) AS rate_a,
  count(*) FILTER (x AND b) / count(*) FILTER (b) AS rate_b, count(*) FILTER (x) / count(*) AS r FROM c),
 z AS (SELECT *, rate_b - rate_a AS diff, (rate_b - rate_a) / sqrt(r * (1 - r) * (1 / n_a + 1 / n_b)) AS z,
  {NormalDist().inv_cdf(0.975)!r} * sqrt(rate_a * (1 - rate_a) / n_a + rate_b * (1 - rate_b) / n_b) AS margin FROM g2),
 lines AS (SELECT metric, 'mean' AS kind, n_a, n_b, mean_a AS value_a, mean_b AS value_b, diff, t AS stat, p, ci_lo,
  ci_hi FROM tested
  UNION ALL SELECT 'payer', 'rate', n_a, n_b, rate_a, rate_b, diff, z, 2 * {normal_sf_sql("abs(z)")}, diff - margin,
  diff + margin FROM z)
 SELECT metric, kind, n_a, n_b, round(value_a + 1e-9, 2) AS value_a, round(value_b + 1e-9, 2) AS value_b,
 round(diff + 1e-9, 2) AS diff, round(stat + 1e-9, 4) AS stat, round(p + 1e-9, 4) AS p, round(ci_lo + 1e-9, 2) AS ci_lo,
 round(ci_hi + 1e-9, 2) AS ci_hi, round(diff / value_a + 1e-9, 4) AS lift, p < 0.05 AS significant FROM lines""",
)
def ab_report(spark, sf_dir):
    big = order_log(spark, sf_dir).where(F.col("amount") > 400000).select("user_id")
    users = flag_exists(_plans(spark, sf_dir), big, "user_id", "payer")
    kinds = {"orders": "mean", "amount": "mean", "payer": "rate"}
    out = experiments.ab_report(users, "plan", kinds, "free", "BUILDING", user="user_id")
    return rounded(out, 2, stat=4, p=4, lift=4)
