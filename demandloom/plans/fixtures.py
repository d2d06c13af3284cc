"""Sales, geo and demand views over the generated test tables.

Dirt is written into the sales text by row number, so that every engine sees the same
rows; no row is dropped here.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.config import Settings
from demandloom.operators.demand import daily_demand

EVENTS = Settings(
    execution_date=date(2024, 1, 31),
    time_delta=30,
    test_size=7,
    steps=9,
    window_size=7,
    metrics=("rmse", "mae"),
    selection_metric="mae",
)
ORDERS = Settings(
    execution_date=date(2001, 7, 1),
    time_delta=364,
    test_size=7,
    steps=9,
    window_size=7,
    metrics=("rmse", "mae"),
    selection_metric="mae",
)

COLD_CITIES = ("NATION_0", "NATION_2")
COLD_START = date(2024, 1, 27)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    user, event = F.col("user_id"), F.col("event_id")
    return events.select(
        F.when(user % 10 < 4, "M").when(user % 10 < 8, "B").otherwise("A").alias("country"),
        F.col("event_type").alias("product_id"),
        F.col("ts").cast("date").alias("date"),
        F.when(event % 53 == 0, F.lit(None)).otherwise(user).alias("zipcode"),
        F.when(event % 97 == 0, F.lit("xfffx"))
        .when(event % 101 == 0, F.lit(None))
        .when(event % 6 == 0, F.lit("9999"))
        .otherwise(F.col("value").cast("string"))
        .alias("sales"),
    )


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").agg(F.max("user_id") + 1).scalar()
    width = F.ceil(users / F.lit(20.0)).cast("bigint")
    nation, key = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    return nation.select(
        F.when(key % 2 == 0, "M").otherwise("B").alias("country"),
        (key * width).alias("s_zipcode"),
        ((key + 1) * width).alias("e_zipcode"),
        F.col("n_name").alias("city"),
    )


def overlapping_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each range stretched over the next one of its country."""
    stretched = F.col("e_zipcode") + F.col("e_zipcode") - F.col("s_zipcode")
    return geo(spark, sf_dir).withColumn("e_zipcode", stretched + F.lit(1))


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_demand(sales(spark, sf_dir), geo(spark, sf_dir))


def cold_start_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cities open four days before execution, so their series have no training days."""
    early = F.col("city").isin(*COLD_CITIES) & (F.col("date") < F.lit(COLD_START))
    return demand(spark, sf_dir).filter(~early)


def orders_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity shipped per nation, brand and day: sparse, intermittent series."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", F.col("l_shipdate").cast("date").alias("date")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("product_id"))
    homes = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    sold_in = orders.join(homes, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "city")
    return (
        lines.join(sold_in, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("city", "product_id", "date")
        .agg(F.sum("l_quantity").alias("sales"))
    )
