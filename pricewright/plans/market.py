"""The driver tables seen as a market: parts are items, line items sales, open orders' lines listings, customers holders.

| market | table |
|---|---|
| item | part: make p_brand, model line p_type, year 1950 + p_size, list price p_retailprice |
| sale | lineitem: price l_extendedprice in dollars, mileage 1000 l_quantity, sold l_shipdate, source supplier |
| flags | l_returnflag 'R': reserve not met; suppliers of number 0 modulo 10: sold abroad |
| listing | lines of orders of status 'O', asked at 0.8 to 1.2 of the price |
| as of | 2001-12-31, for events 2024-02-01 |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-12-31 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), (F.col("p_size") + 1950).alias("year"), F.col("p_brand").alias("make"), F.col("p_name").alias("model"), F.col("p_type").alias("model_key"), F.lit(None).cast("string").alias("body"), F.col("p_retailprice").alias("msrp"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    unsold = F.col("l_returnflag") == "R"
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item_id"),
        F.col("l_orderkey").alias("lot"),
        F.col("l_linenumber").alias("line"),
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("source"),
        F.col("l_suppkey").alias("source_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_extendedprice").alias("price_usd"),
        F.lit("USD").alias("currency"),
        (F.col("l_quantity") * 1000).alias("mileage"),
        F.col("l_shipdate").cast("timestamp").alias("sold_at"),
        F.when(unsold, "reserve_not_met").otherwise("sold").alias("status"),
        unsold.alias("reserve_not_met"),
        (F.col("l_suppkey") % 10 == 0).alias("non_us_sale"),
        F.lit(False).alias("is_outlier"),
        F.lit(False).alias("carfax_damage"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active asks: one for each line of an open order."""
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("lot"), F.col("o_orderdate").cast("timestamp").alias("first_seen"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("lot"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("item_id"), F.col("l_extendedprice").alias("price"), (F.col("l_quantity") * 1000).alias("mileage"), F.col("l_discount").alias("discount"))
    ask = F.round(F.col("price") * (0.8 + 4 * F.col("discount")), 2)
    return lines.join(orders, "lot").select("item_id", "lot", "line", ask.alias("ask"), "mileage", "first_seen")


def listing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_listings"))
