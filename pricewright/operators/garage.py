"""What holders enter: cleaned input, an append-only table of changes with its latest view, daily snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import publish

#: A holding has so many options at most.
OPTIONS = 100


def _blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def clean_text(value: Column, most: int, field: str) -> tuple[Column, Column]:
    """(value, error): trimmed text, null if nothing is left; too long a text is an error."""
    text = F.trim(value)
    long = F.length(text) > most
    return F.when(~_blank(value) & ~long, F.nullif(text, F.lit(""))), F.when(~_blank(value) & long, f"{field} is too long")


def clean_date(value: Column, field: str) -> tuple[Column, Column]:
    """(value, error): a real date written YYYY-MM-DD."""
    shaped = value.rlike(r"^\d{4}-\d{2}-\d{2}$")
    date = F.when(shaped, F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).cast("date"))
    return F.when(~_blank(value), date), F.when(_blank(value), None).when(~shaped, f"{field} must be YYYY-MM-DD").when(date.isNull(), f"{field} is not a real date")


def clean_integer(value: Column, field: str) -> tuple[Column, Column]:
    """(value, error): a whole number of zero or more."""
    n = value.try_cast("double")
    good = n.isNotNull() & ~F.isnan(n) & (n >= 0) & (F.abs(n) < 9e15) & (n == F.floor(n))
    return F.when(~_blank(value) & F.coalesce(good, F.lit(False)), n.cast("long")), F.when(~_blank(value) & ~F.coalesce(good, F.lit(False)), f"{field} must be a non-negative whole number")


def clean_options(value: Column, field: str = "options") -> tuple[Column, Column]:
    """(value, error): a JSON array of texts, trimmed, without empty ones; none given is an empty array."""
    parsed = F.from_json(value, "array<string>")
    texts = F.coalesce(F.regexp_count(F.coalesce(value, F.lit("")), F.lit(r'"(?:[^"\\]|\\.)*"')) == F.size(parsed), F.lit(False))
    kept = F.slice(F.filter(F.transform(parsed, lambda x: F.trim(x)), lambda x: x != ""), 1, OPTIONS)
    good = F.trim(value).rlike(r"^\[") & parsed.isNotNull() & texts
    return F.when(_blank(value), F.array().cast("array<string>")).when(F.coalesce(good, F.lit(False)), kept), F.when(~_blank(value) & ~F.coalesce(good, F.lit(False)), f"{field} must be an array of text values")


def latest(changes: DataFrame, key: str, at: str, tie: str, fields: Sequence[str], action: str = "action") -> DataFrame:
    """Holdings by the changes made to them (create, patch, archive): of each field the last value given; one aggregation.

    A patch says nothing of the fields it leaves null. What was archived last is ``archived``, else ``owned``.
    """
    last = lambda c, when=None: F.max_by(c, F.when(F.lit(True) if when is None else when, F.struct(at, tie)))
    return changes.groupBy(key).agg(
        *[last(f, F.col(f).isNotNull()).alias(f) for f in fields],
        F.when(last(action) == "archive", "archived").otherwise("owned").alias("status"),
        F.min(at).alias("created_at"),
        F.max(at).alias("updated_at"),
    )


def in_garage_order(holdings: DataFrame, key: str) -> DataFrame:
    """Owned ones first, then the latest changed; the key settles ties."""
    return holdings.orderBy(F.when(F.col("status") == "owned", 0).otherwise(1), F.desc("updated_at"), key)


def snapshots_after(stored: DataFrame, taken: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Daily snapshots with those taken today: one for each key (holding and day), the newer values stand."""
    return publish.merged(stored, taken, key, list(values), [])
