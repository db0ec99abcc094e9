"""Listing lifecycle as a stream: exactly once by natural key, late results within 45 days, idempotent merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lifecycle import closing
from ..operators.publish import merged

#: A closed auction is looked at again for so long.
LATE = "45 days"


def observed(states: DataFrame, key: list[str], at: str = "observed_at") -> DataFrame:
    """A stream of observations, each counted once by key, state and time, those later than LATE dropped."""
    return states.withWatermark(at, LATE).dropDuplicatesWithinWatermark([*key, "state", at])


def daily_counts(states: DataFrame, at: str = "observed_at") -> DataFrame:
    """Observations by day and state, kept open for LATE."""
    return states.withWatermark(at, LATE).groupBy(F.window(at, "1 day"), "state").count()


def merge_batches(path: str, key: str):
    """A foreachBatch sink: the table under ``path`` takes each batch's last states in a new version; replays change nothing."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = closing(batch, key, "state", "observed_at", "event_id").select(key, "state", "closed_at")
        target = f"{path}/version={batch_id}"
        if batch_id:
            old = spark.read.parquet(f"{path}/version={batch_id - 1}")
            new = merged(old, new, [key], ["state", "closed_at"], [], lambda o: o("closed_at").isNull())
        new.write.mode("overwrite").parquet(target)

    return sink
