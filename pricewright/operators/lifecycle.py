"""Lifecycle of a listing: live until it is sold, sold after the auction, or ends; a closed one stays closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLOSED = ("sold", "sold_after", "ended")


def closing(states: DataFrame, key: str, state: str, at: str, tie: str) -> DataFrame:
    """(key, state, opened_at, closed_at, n): the first closing state in time, else the last state; one aggregation."""
    when = F.struct(F.col(at).alias("at"), F.col(tie).alias("tie"), F.col(state).alias("state"))
    closes = F.col(state).isin(*CLOSED)
    g = states.groupBy(key).agg(F.min(F.when(closes, when)).alias("closed"), F.max(when).alias("last"), F.min(at).alias("opened_at"), F.count("*").alias("n"))
    return g.select(key, F.coalesce("closed.state", "last.state").alias("state"), "opened_at", F.col("closed.at").alias("closed_at"), "n")


def transition(was: Column, now: Column) -> Column:
    """State after an observation: closed states hold, but a sale after the end counts."""
    return F.when(was == "ended", F.when(now.isin("sold", "sold_after"), "sold_after").otherwise(was)).when(was.isin("sold", "sold_after"), was).otherwise(F.coalesce(now, was))
