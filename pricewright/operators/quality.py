"""Checks of records, harvests and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A field may lose so much of its share of filled values; with fewer records than the second a harvest is low.
MAX_DROP, LOW_YIELD = 0.35, 5


def population(records: DataFrame, fields: Sequence[str], by: str = "source") -> DataFrame:
    """(by, n, field, share): share of records of a source in which a field is filled (neither null nor empty)."""
    filled = [F.avg(F.when(F.col(f).isNotNull() & (F.col(f).cast("string") != ""), 1.0).otherwise(0.0)).alias(f) for f in fields]
    return records.groupBy(by).agg(F.count("*").alias("n"), *filled).unpivot([by, "n"], list(fields), "field", "share")


def drift(now: DataFrame, baseline: DataFrame, by: str = "source") -> DataFrame:
    """Population against a baseline (by, field, base_share): ``drifted`` if the share fell by more than MAX_DROP, ``low`` if records are few."""
    j = now.join(baseline.select(by, "field", "base_share"), [by, "field"])
    return j.withColumn("drop", F.col("base_share") - F.col("share")).withColumn("drifted", F.col("drop") > MAX_DROP).withColumn("low", F.col("n") < LOW_YIELD)


def record_errors(as_of: Column) -> Column:
    """Array of what is wrong with a sale record; empty if nothing is."""
    date = F.col("sold_at").cast("timestamp")
    checks = [
        (F.col("source").isNull() | (F.col("source") == ""), "source missing"),
        (F.col("lot").isNull(), "lot id missing"),
        (F.col("title").isNull() | (F.trim("title") == ""), "title missing"),
        (date.isNull(), "sale date missing or invalid"),
        (date > as_of + F.expr("interval 1 day"), "sale date in the future"),
        (F.col("price").isNull() & ~F.col("status").eqNullSafe("reserve_not_met"), "price missing"),
        (F.col("price") <= 0, "price not positive"),
        (F.col("mileage") < 0, "mileage negative"),
    ]
    return F.array_compact(F.array(*[F.when(c, m) for c, m in checks]))


def repeated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def freshness(df: DataFrame, at: str, as_of: Column, by: str = "source") -> DataFrame:
    """Newest record of each source, and records of the last 14, 30 and 90 days."""
    days = F.datediff(as_of, F.col(at))
    return df.groupBy(by).agg(F.max(at).alias("newest"), *[F.count_if(days <= n).alias(f"last_{n}") for n in (14, 30, 90)])


def health(records: DataFrame, drifts: DataFrame, as_of: Column, by: str = "source") -> DataFrame:
    """(by, n, invalid, drifted, low, status): record checks and drift of each source in one report.

    ``drifts`` is the outcome of ``drift``; a source without a baseline has null flags there.
    """
    checked = records.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.size(record_errors(as_of)) > 0).alias("invalid"))
    flags = drifts.groupBy(by).agg(F.bool_or("drifted").alias("drifted"), F.bool_or("low").alias("low"))
    j = checked.join(flags, by, "left")
    return j.withColumn("status", F.when((F.col("invalid") > 0) | F.coalesce(F.col("drifted") | F.col("low"), F.lit(False)), "NEEDS_REVIEW").when(F.col("drifted").isNull(), "BASELINE_ESTABLISHED").otherwise("OK"))


def saved_baseline(now: DataFrame, path: str, by: str = "source") -> None:
    """Keep the shares of a harvest (``population``) as the baseline of the next one."""
    now.select(by, "field", F.col("share").alias("base_share")).write.mode("overwrite").json(path)


def baseline(spark, path: str, by: str = "source") -> DataFrame:
    """The baseline kept at ``path``; none is an empty one."""
    schema = f"`{by}` string, field string, base_share double"
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)
    return spark.read.schema(schema).json(path) if found else spark.createDataFrame([], schema)
