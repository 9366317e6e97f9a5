"""Queries for sources, data quality, preprocessing, joins and marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T
from pyspark.sql import functions as F

from growthkit.operators import marts, prepare, quality, unit_econ
from growthkit.plans.adapters import event_log, table
from growthkit.plans.registry import query, rounded
from growthkit.session import scratch_path
from growthkit.sources.tables import load_tables, read_csv, write_slice

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@query(
    "src_csv",
    """SELECT o_orderstatus, count(*) AS n, CAST(0 AS BIGINT) AS corrupt,
 round(sum(o_totalprice) + 1e-9, 2) AS total, CAST(min(o_orderdate) AS DATE) AS first_day
 FROM orders GROUP BY o_orderstatus""",
)
def src_csv(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    # The file's columns stand in another order than the schema's: they are read by name.
    orders = table(spark, sf_dir, "orders")
    orders.select(*reversed(ORDERS_SCHEMA.names)).write.option("header", True).csv(path)
    return rounded(
        read_csv(spark, path, ORDERS_SCHEMA)
        .groupBy("o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("_corrupt").alias("corrupt"),
            F.sum("o_totalprice").alias("total"),
            F.to_date(F.min("o_orderdate")).alias("first_day"),
        ),
        total=2,
    )


@query(
    "src_slice",
    """SELECT o_orderstatus, CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n,
 round(sum(o_totalprice) + 1e-9, 2) AS total
 FROM orders GROUP BY 1, 2""",
)
def src_slice(spark, sf_dir):
    path = scratch_path(spark, "orders-slice")
    write_slice(table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")), path, ["year"])
    back = spark.read.parquet(path)
    return rounded(
        back.groupBy("o_orderstatus", F.col("year").cast("bigint").alias("year")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")
        ),
        total=2,
    )


@query(
    "src_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}"
        for t in ("customer", "orders", "lineitem", "part", "supplier", "events", "documents", "labels")
    ),
)
def src_tables(spark, sf_dir):
    names = ["customer", "orders", "lineitem", "part", "supplier", "events", "documents", "labels"]
    counts = None
    for name, df in load_tables(spark, sf_dir, names).items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    "mart_gsets",
    """SELECT p_brand, p_type, count(*) AS n, round(avg(p_retailprice) + 1e-9, 4) AS avg_price,
 CAST(max(p_size) AS BIGINT) AS max_size,
 CAST(grouping(p_brand) AS BIGINT) AS g_p_brand, CAST(grouping(p_type) AS BIGINT) AS g_p_type
 FROM part GROUP BY GROUPING SETS ((p_brand, p_type), (p_brand), ())""",
)
def mart_gsets(spark, sf_dir):
    return rounded(
        marts.mart(
            table(spark, sf_dir, "part"),
            ["p_brand", "p_type"],
            {
                "n": ("count", F.lit(1)),
                "avg_price": ("avg", "p_retailprice"),
                "max_size": ("max", F.col("p_size").cast("bigint")),
            },
            [["p_brand", "p_type"], ["p_brand"], []],
        )
    )


@query(
    "mart_cube",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice) + 1e-9, 2) AS total,
 CAST(grouping(o_orderstatus) AS BIGINT) AS g_o_orderstatus,
 CAST(grouping(o_orderpriority) AS BIGINT) AS g_o_orderpriority
 FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
def mart_cube(spark, sf_dir):
    return rounded(
        marts.mart(
            table(spark, sf_dir, "orders"),
            ["o_orderstatus", "o_orderpriority"],
            {"n": ("count", F.lit(1)), "total": ("sum", "o_totalprice")},
        ),
        total=2,
    )


@query(
    "dq_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(*) AS n, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_distinct"
        " FROM orders"
        for c in ORDERS_SCHEMA.names
    ),
)
def dq_profile(spark, sf_dir):
    return quality.profile(table(spark, sf_dir, "orders"), exact=True)


@query(
    "dq_profile_filled",
    " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(*) AS n, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_distinct"
        " FROM documents LEFT JOIN labels USING (doc_id)"
        for c in ("lang", "source", "n_chars", "quality", "toxic")
    ),
)
def dq_profile_filled(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["documents", "labels"])
    joined = t["documents"].select("doc_id", "lang", "source", "n_chars").join(t["labels"], "doc_id", "left")
    return quality.profile(joined, ["lang", "source", "n_chars", "quality", "toxic"], exact=True)


@query(
    "dq_rules",
    """WITH r AS (SELECT
 c_acctbal >= 0 AS balance_not_negative,
 c_name LIKE 'Customer#%' AS name_has_prefix,
 c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS known_segment FROM customer)
 SELECT 'balance_not_negative' AS rule, count(*) FILTER (NOT balance_not_negative) AS violations,
  round(count(*) FILTER (NOT balance_not_negative) / count(*) + 1e-9, 4) AS share FROM r
 UNION ALL SELECT 'name_has_prefix', count(*) FILTER (NOT name_has_prefix),
  round(count(*) FILTER (NOT name_has_prefix) / count(*) + 1e-9, 4) FROM r
 UNION ALL SELECT 'known_segment', count(*) FILTER (NOT known_segment),
  round(count(*) FILTER (NOT known_segment) / count(*) + 1e-9, 4) FROM r""",
)
def dq_rules(spark, sf_dir):
    return rounded(
        quality.check_rules(
            table(spark, sf_dir, "customer"),
            {
                "balance_not_negative": F.col("c_acctbal") >= 0,
                "name_has_prefix": F.col("c_name").startswith("Customer#"),
                "known_segment": F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"),
            },
        )
    )


@query(
    "dq_duplicates",
    """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(n) - count(*) AS BIGINT) AS surplus
 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) AS k""",
)
def dq_duplicates(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_dedupe",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def dq_dedupe(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return prepare.dedupe(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"])


@query(
    "dq_orphans",
    """WITH a AS (SELECT count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  GROUP BY o_orderkey),
 b AS (SELECT count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey),
 c AS (SELECT count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id)
 SELECT 'order without line' AS relation, count(*) AS n_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows FROM a
 UNION ALL SELECT 'order without customer', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM b
 UNION ALL SELECT 'document without label', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM c""",
)
def dq_orphans(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["orders", "lineitem", "customer", "documents", "labels"])
    reports = [
        ("order without line", t["orders"], t["lineitem"], {"o_orderkey": "l_orderkey"}),
        ("order without customer", t["orders"], t["customer"], {"o_custkey": "c_custkey"}),
        ("document without label", t["documents"], t["labels"], {"doc_id": "doc_id"}),
    ]
    out = None
    for label, child, parent, on in reports:
        one = quality.orphan_report(child, parent, on).select(F.lit(label).alias("relation"), "n_keys", "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "dq_orphan_rows",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
 WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def dq_orphan_rows(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["orders", "lineitem"])
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus")
    return quality.orphans(orders, t["lineitem"], {"o_orderkey": "l_orderkey"})


@query(
    "prep_fill",
    """WITH j AS (SELECT doc_id, lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
 m AS (SELECT source, quantile_cont(CAST(quality AS DOUBLE), 0.5) AS med FROM j GROUP BY source)
 SELECT doc_id, lang, source, CAST(coalesce(quality, med) AS DOUBLE) AS quality,
 CAST(coalesce(toxic, 0) AS INTEGER) AS toxic FROM j JOIN m USING (source)""",
)
def prep_fill(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["documents", "labels"])
    joined = t["documents"].select("doc_id", "lang", "source").join(t["labels"], "doc_id", "left")
    # a median of 0 and 1 may be a half, which a double can hold
    joined = joined.withColumn("quality", F.col("quality").cast("double"))
    return prepare.fill_missing(prepare.fill_missing(joined, {"toxic": 0}), ["quality"], by=["source"])


@query(
    "prep_drop",
    """SELECT source, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id)
 WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY source""",
)
def prep_drop(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["documents", "labels"])
    joined = t["documents"].select("doc_id", "source").join(t["labels"], "doc_id", "left")
    return prepare.drop_missing(joined, ["quality", "toxic"]).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "prep_coerce",
    """SELECT c_custkey, TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS number,
 TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) IS NULL AS number_bad,
 TRY_CAST(c_mktsegment AS DOUBLE) AS segment, TRY_CAST(c_mktsegment AS DOUBLE) IS NULL AS segment_bad
 FROM customer""",
)
def prep_coerce(spark, sf_dir):
    texts = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("number"),
        F.col("c_mktsegment").alias("segment"),
    )
    return prepare.coerce(texts, {"number": "bigint", "segment": "double"})


@query("prep_normalize", "SELECT p_partkey, lower(trim(p_name)) AS name FROM part")
def prep_normalize(spark, sf_dir):
    untidy = F.concat(F.lit("  "), F.upper(F.replace("p_name", F.lit(" "), F.lit("   "))), F.lit(" "))
    return prepare.normalize(table(spark, sf_dir, "part").select("p_partkey", untidy.alias("name")), "name")


@query(
    "prep_slice",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
 WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'""",
)
def prep_slice(spark, sf_dir):
    at = F.col("o_orderdate")
    period = (at >= F.lit(dt.date(1997, 1, 1))) & (at < F.lit(dt.date(2000, 1, 1)))
    return prepare.slice_(table(spark, sf_dir, "orders"), period, ["o_orderkey", "o_orderdate", "o_totalprice"])


@query(
    "prep_band",
    """SELECT c_custkey, CASE WHEN c_acctbal <= 0 THEN 'debt' WHEN c_acctbal <= 5000 THEN 'low' ELSE 'high' END AS band
 FROM customer""",
)
def prep_band(spark, sf_dir):
    banded = prepare.band(
        table(spark, sf_dir, "customer"), "c_acctbal", [0, 5000], ["debt", "low", "high"], name="band"
    )
    return banded.select("c_custkey", "band")


@query(
    "prep_fence",
    """SELECT event_id, value FROM events, (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi
 FROM events) AS q WHERE value BETWEEN lo AND hi""",
)
def prep_fence(spark, sf_dir):
    return prepare.fence(table(spark, sf_dir, "events").select("event_id", "value"), "value")


@query(
    "prep_fence_by",
    """SELECT event_id, event_type, value FROM events JOIN (SELECT event_type, quantile_cont(value, 0.05) AS lo,
 quantile_cont(value, 0.95) AS hi FROM events GROUP BY event_type) AS q USING (event_type)
 WHERE value BETWEEN lo AND hi""",
)
def prep_fence_by(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return prepare.fence(rows, "value", 0.05, 0.95, by="event_type")


@query(
    "join_enrich",
    """SELECT p_partkey, p_brand, n_lines, round(avg_price + 1e-9, 4) AS avg_price FROM part LEFT JOIN
 (SELECT l_partkey, count(*) AS n_lines, avg(l_extendedprice) AS avg_price FROM lineitem GROUP BY l_partkey) AS l
 ON l_partkey = p_partkey""",
)
def join_enrich(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["part", "lineitem"])
    prices = (
        t["lineitem"]
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count(F.lit(1)).alias("n_lines"), F.avg("l_extendedprice").alias("avg_price"))
    )
    # The aggregate's key is unique by construction.
    return rounded(prepare.enrich(t["part"].select("p_partkey", "p_brand"), prices, "p_partkey", check=False))


@query(
    "join_payers",
    """SELECT c_custkey, c_mktsegment,
 EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS payer FROM customer""",
)
def join_payers(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["customer", "orders"])
    big = t["orders"].where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return prepare.flag_exists(t["customer"].select("c_custkey", "c_mktsegment"), big, "c_custkey", "payer")


@query(
    "join_within_age",
    """WITH s AS (SELECT user_id, CAST(min(ts) AS DATE) AS d0 FROM events GROUP BY user_id)
 SELECT CAST(date_diff('day', d0, CAST(ts AS DATE)) AS BIGINT) AS age, event_type, count(*) AS n,
 round(sum(value) + 1e-9, 2) AS total
 FROM events JOIN s USING (user_id) WHERE date_diff('day', d0, CAST(ts AS DATE)) BETWEEN 0 AND 27 GROUP BY 1, 2""",
)
def join_within_age(spark, sf_dir):
    events = event_log(spark, sf_dir)
    start = events.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    young = unit_econ.within_age(events, start, "user_id", "ts", "first_ts", 28)
    return rounded(
        young.groupBy("age", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), total=2
    )
