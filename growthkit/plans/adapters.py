"""The given tables seen as the inputs the operators expect: users, events, orders, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthkit.functions.ordering import with_neighbour
from growthkit.sources.tables import load_tables

# Marketing spend per acquisition channel.
COSTS = [
    ("AFRICA", 900.0),
    ("AMERICA", 2400.0),
    ("ASIA", 1500.0),
    ("EUROPE", 4000.0),
    ("MIDDLE EAST", 30000.0),
]

# The same inputs in SQL, for the checks.
USERS_SQL = """(SELECT c_custkey AS user_id, c_mktsegment AS platform, r_name AS channel, n_name AS place
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
COSTS_SQL = "(VALUES " + ", ".join(f"('{c}', CAST({v} AS DOUBLE))" for c, v in COSTS) + ") AS costs(channel, cost)"
LISTINGS_SQL = """(SELECT o_orderkey AS id, o_custkey, o_totalprice AS price, CAST(o_orderdate AS DATE) AS opened,
 CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE) AS closed
 FROM orders)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_tables(spark, sf_dir, [name])[name]


def user_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: user_id, platform, channel, place."""
    t = load_tables(spark, sf_dir, ["customer", "nation", "region"])
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t["customer"]
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_mktsegment").alias("platform"),
            F.col("r_name").alias("channel"),
            F.col("n_name").alias("place"),
        )
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a purchase log: order_id, user_id, ts, amount."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("amount"),
    )


def event_revenue() -> Column:
    return F.when(F.col("event_type") == "purchase", F.col("value"))


def costs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COSTS, "channel string, cost double")


def listing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order stands for a listing that closes with the customer's next order -> id, user_id, price, opened, closed."""
    dated = with_neighbour(order_log(spark, sf_dir), "user_id", "ts", "order_id", "ts", grain="month")
    return dated.select(
        F.col("order_id").alias("id"),
        "user_id",
        F.col("amount").alias("price"),
        F.to_date("ts").alias("opened"),
        F.to_date("next.ts").alias("closed"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`listing_dates` with the place of the owner: platform, channel, place."""
    return listing_dates(spark, sf_dir).join(user_dim(spark, sf_dir), "user_id", "left")
