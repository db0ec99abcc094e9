"""What landed pages hold: embedded JSON, labelled text, bullets, dates in prose, slugs of urls."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as E
from .adapters import first, gearbox, miles, text

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def next_data(html: Column, path: str) -> Column:
    """A value of the JSON that a page embeds for its scripts, as text; null without it."""
    return F.get_json_object(first(html, r'(?s)<script id="__NEXT_DATA__" type="application/json">(.*?)</script>'), path)


def balanced_objects(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``pages`` with ``object``: the brace-balanced JSON object after ``key`` in escaped script text, null if it never closes.

    No regular expression balances braces; strings within the object may hold any.
    """

    def cut(source: str | None) -> str | None:
        plain = (source or "").replace('\\"', '"').replace("\\\\", "\\")
        at = plain.find(key)
        start = plain.find("{", at) if at >= 0 else -1
        if start < 0:
            return None
        depth, inside, escaped = 0, False, False
        for i in range(start, len(plain)):
            c = plain[i]
            if inside:
                escaped, inside = (c == "\\" and not escaped), (c != '"' or escaped)
            elif c == '"':
                inside = True
            elif c in "{}":
                depth += 1 if c == "{" else -1
                if not depth:
                    return plain[start : i + 1]
        return None

    schema = pages.withColumn("object", F.lit("")).schema

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(object=[cut(x) for x in b[html]])

    schema["object"].nullable = True
    return pages.mapInPandas(step, schema)


def labelled(body: Column, label: str) -> Column:
    """Text after ``label:`` up to the end of its line."""
    return F.trim(first(body, rf"(?im)^\s*{label}\s*:?\s*[:\n]\s*([^\n]+)"))


def bullets(pages: DataFrame, key: str = "lot") -> DataFrame:
    """(key, mileage, vin, transmission, color) from a list of bullets (array ``bullets``): of each kind the first that says it."""
    b = pages.select(key, F.posexplode_outer("bullets").alias("pos", "bullet"))
    vin = F.when(b.bullet.rlike("(?i)^(?:chassis|vin)"), E.normal_vin(F.regexp_replace(b.bullet, "(?i)^(?:chassis|vin)[^A-Z0-9]*", "")))
    color = first(b.bullet, r"(?i)^(?:paint|finished in|repainted in)?\s*([A-Za-z ]+?) (?:paint|exterior)\b")
    said = b.select(key, "pos", miles("bullet").alias("mileage"), vin.alias("vin"), gearbox("bullet").alias("transmission"), color.alias("color"))
    return said.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("pos"))).alias(c) for c in ("mileage", "vin", "transmission", "color")])


def enriched(records: DataFrame, pages: DataFrame) -> DataFrame:
    """``records`` with what their detail pages add, if page and record agree on title and price.

    ``pages``: lot, page_title, page_price, mileage, vin, transmission. A record keeps what it has.
    """
    plain = lambda c: F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", "")
    p = pages.select("lot", "page_title", "page_price", *[F.col(c).alias(f"p_{c}") for c in ("mileage", "vin", "transmission")])
    j = records.join(p, "lot", "left")
    agree = F.coalesce((plain("title") == plain("page_title")) & (F.col("page_price") == F.col("price")), F.lit(False))
    return j.select(*[F.coalesce(F.col(c), F.when(agree, F.col(f"p_{c}"))).alias(c) if c in ("mileage", "vin", "transmission") else F.col(c) for c in records.columns])


def last_date_in_prose(body: Column) -> Column:
    """Noon of the last date of the last range in prose: "March 22-26, 2024", "January 30 - February 2, 2025"."""
    found = F.regexp_extract_all(body, F.lit(rf"((?:{MONTHS})\s+\d{{1,2}}(?:\s*[-–]\s*(?:(?:{MONTHS})\s+)?\d{{1,2}})?,?\s+\d{{4}})"), F.lit(1))
    last = F.try_element_at(found, F.lit(-1))
    month, day, year = first(last, rf".*\b({MONTHS})\b"), first(last, r"(\d{1,2}),?\s+\d{4}$"), first(last, r"(\d{4})$")
    return F.try_to_timestamp(F.concat_ws(" ", month, day, year), F.lit("MMMM d yyyy")) + F.expr("interval 12 hours")


def last_session(sessions: Column) -> Column:
    """Latest end of an array of ISO times."""
    return F.array_max(F.transform(sessions, lambda s: F.try_to_timestamp(s)))


#: Fixed values (patterns): where each source's urls hold year, make and model, as one slug.
SLUGS = {
    "bat": r"/listing/([^/?#]+)", "cab": r"/auctions/[^/?#]+/([^/?#]+)", "rms": r"/lots/([^/?#]+)", "mecum": r"/lots/[^/]+/([^/?#]+)", "bon": r"/lot/[^/]+/([^/?#]+)",
    "good": r"/lot/([^/?#]+)", "sms": r"/listings?/([^/?#]+)", "bj": r"/docket/vehicle/([^/?#]+?)-\d+(?:[?#]|$)", "broadarrow": r"/vehicles/[^/]+/([^/?#]+)",
}


def slug_parts(source: Column, url: Column) -> Column:
    """struct(year, rest) of the slug in a source's url; null for sources without one or slugs without a year."""
    slug = F.lit(None).cast("string")
    for name, pattern in SLUGS.items():
        slug = F.when(source == name, first(F.lower(url), pattern)).otherwise(slug)
    year = first(slug, r"(?:^|-)(1[89]\d{2}|20[0-4]\d)(?:-|$)")
    rest = F.regexp_replace(F.regexp_replace(slug, r"(?:^|-)(?:1[89]\d{2}|20[0-4]\d)(?=-|$)", ""), r"^-|-$", "")
    return F.when(year.isNotNull() & (rest != ""), F.struct(year.cast("int").alias("year"), rest.alias("rest")))


def slug_conflict(source: Column, url: Column, year: Column) -> Column:
    """Whether a url names another year than the title."""
    return F.coalesce(slug_parts(source, url)["year"] != year, F.lit(False))


