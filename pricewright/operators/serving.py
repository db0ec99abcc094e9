"""Projections that are served: an item in full, by tier; repricing; holdings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as E

TIERS = ("free", "plus", "pro")
#: Columns that a tier sees from; others are open to all.
GATED = {"confidence": "plus", "annual_return": "plus", "trend_score": "plus", "liquidity": "plus", "forecast_1y": "plus", "forecast_3y": "pro", "forecast_5y": "pro", "bear_3y": "pro", "bull_3y": "pro", "bear_5y": "pro", "bull_5y": "pro"}
#: Sales that the lowest tier sees.
FREE_SALES = 5


def tiered(df: DataFrame, tier: str) -> DataFrame:
    """``df`` with what the tier may not see nulled, and arrays of sales cut to the newest few for the lowest."""
    rank = TIERS.index(tier)
    out = []
    for field in df.schema:
        c = F.col(field.name)
        if TIERS.index(GATED.get(field.name, "free")) > rank:
            c = F.lit(None).cast(field.dataType).alias(field.name)
        elif field.name == "sales" and rank == 0:
            c = F.slice(c, 1, FREE_SALES).alias("sales")
        out.append(c)
    return df.select(*out)


def detail(values: DataFrame, sales: DataFrame, listings: DataFrame) -> DataFrame:
    """Each valued item with its sales, newest first, and its asks, lowest first, as arrays of structs."""
    s = sales.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("sold_at", "lot", "line", "price", "mileage", "status")), False).alias("sales"))
    l = listings.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("ask", "lot", "line", "mileage"))).alias("listings"))
    return values.join(s, "item_id", "left").join(l, "item_id", "left")


def repriced(values: DataFrame, miles: Column) -> DataFrame:
    """``values`` with ``repriced``: the item's value at another mileage; null without a value."""
    return values.withColumn("repriced", E.mileage_adjusted(F.col("current_value"), miles, F.coalesce(F.col("avg_mileage"), miles), F.col("desirability"), F.greatest(F.col("age"), F.lit(0))))


def reliable_trend(score: Column, annual: Column) -> Column:
    """Whether what is left of a trend after shrinkage is half of it at least."""
    return F.abs(score / F.nullif(annual, F.lit(0.0))) >= 0.5


def changes_by_day(snapshots: DataFrame) -> DataFrame:
    """Snapshots with the change from the one before of the same holding."""


    own = Window.partitionBy("holding_id").orderBy("day")
    return snapshots.withColumn("change", F.col("market_value") - F.lag("market_value").over(own))
