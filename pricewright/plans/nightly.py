"""The nightly run: stages in order, required ones stopping what follows, each recorded in a history."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import publish
from ..operators import valuation as V


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[[], object]
    required: bool = True


def run_stages(stages: Sequence[Stage], only: Sequence[str] = (), skip: Sequence[str] = (), deadline_s: float | None = None) -> list[dict]:
    """Run stages in order and say of each how it ended: ok, failed, skipped, or blocked by a required one before it.

    After the deadline nothing is begun. A failure of an optional stage stops nothing.
    """
    began, blocked, out = time.monotonic(), False, []
    for stage in stages:
        at, outcome, error = time.monotonic(), "ok", None
        if (only and stage.name not in only) or stage.name in skip:
            outcome = "skipped"
        elif blocked or (deadline_s is not None and at - began > deadline_s):
            outcome = "blocked"
        else:
            try:
                stage.run()
            except Exception as e:  # a stage's failure is its outcome
                outcome, error, blocked = "failed", str(e).splitlines()[0] if str(e) else type(e).__name__, blocked or stage.required
        out.append({"stage": stage.name, "outcome": outcome, "error": error, "seconds": round(time.monotonic() - at, 3)})
    return out


def value_all(sales: DataFrame, items: DataFrame, listings: DataFrame, as_of) -> DataFrame:
    """The valuation of every item with the fallback to its model line, and its trend score: always in full."""
    counts = listings.groupBy("item_id").agg(F.count("*").alias("n_listings"))
    return V.with_trend_score(V.with_fallback(sales, items, counts, as_of))


def nightly(spark: SparkSession, sales: DataFrame, items: DataFrame, listings: DataFrame, as_of, path: str, version: int) -> list[dict]:
    """Write ``version`` of the valuations and what changed from the one before; append the run to the history."""
    now, before = f"{path}/valuations/version={version}", f"{path}/valuations/version={version - 1}"

    def difference() -> None:
        new, old = spark.read.parquet(now), spark.read.parquet(before)
        publish.changed_rows(new, old, ["item_id"]).write.mode("overwrite").parquet(f"{path}/changes/version={version}")

    stages = [Stage("compute", lambda: value_all(sales, items, listings, as_of).write.mode("overwrite").parquet(now))]
    if version:
        stages.append(Stage("publish", difference, required=False))
    out = run_stages(stages)
    for entry in out:
        publish.append_history(spark, f"{path}/history", entry | {"version": version})
    return out
