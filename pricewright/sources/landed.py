"""Readers of landed files: harvested JSON arrays, reference-rate CSV, tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sidecars that stand beside harvest files.
SIDECARS = r"\.(?:state|plan|meta|progress)\.json$"
#: A normalised sale or listing; everything a source has besides is in ``extra`` as JSON.
RECORD = (
    "source string, lot string, url string, title string, sold_at timestamp, price double, currency string, price_usd double, mileage double, vin string, transmission string, image_url string, "
    "non_us_sale boolean, reserve_not_met boolean, status string, listing_type string, listing_status string, price_type string, current_bid double, estimate_low double, estimate_high double, ends_at timestamp, closed_at timestamp, is_active boolean, extra string"
)


def harvested(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of every ``*.json`` file under ``path`` that is no sidecar and whose root is an array, with (file, ordinal).

    A truncated or other file yields nothing, as a whole. The order is that of files and of the arrays.
    """
    raw = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).text(path).withColumn("file", F.input_file_name())
    kept = raw.filter(~F.col("file").rlike(SIDECARS) & F.trim("value").startswith("["))
    parsed = kept.select("file", F.try_parse_json("value").alias("ok"), F.from_json("value", f"array<struct<{schema_fields(schema)}>>").alias("records")).filter("ok is not null")
    return parsed.select("file", F.posexplode("records").alias("ordinal", "record")).select("file", "ordinal", "record.*")


def schema_fields(schema: str) -> str:
    """``name type`` pairs of a flat or nested DDL schema as the fields of a struct type."""
    depth, out = 0, ""
    field_start = True
    for ch in schema:
        depth += (ch in "<(") - (ch in ">)")
        if field_start and ch == " " and out and not out.endswith((",", " ")):
            out += ":"
            field_start = False
            continue
        out += ch
        if ch == "," and depth == 0:
            field_start = True
    return out


def reference_rates(spark: SparkSession, path: str) -> DataFrame:
    """(rate_date, currency, per_eur) from a wide CSV with a Date column; values that are no positive number are dropped, and days without dollars."""
    wide = spark.read.option("header", True).csv(path)
    day = next(c for c in wide.columns if c.strip().lower() == "date")
    others = [c for c in wide.columns if c != day and c.strip()]
    long = wide.select(F.try_to_date(F.trim(F.col(f"`{day}`"))).alias("rate_date"), *[F.expr(f"try_cast(trim(`{c}`) as double)").alias(c.strip()) for c in others]).unpivot(["rate_date"], [c.strip() for c in others], "currency", "per_eur")
    good = long.filter("rate_date is not null and per_eur > 0")
    return good.join(good.filter("currency = 'USD'").select("rate_date").distinct(), "rate_date", "left_semi")


def tables(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}.parquet") for n in names}
