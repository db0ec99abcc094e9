import datetime
import json

import pytest
from pyspark.sql import functions as F

from pricewright.sources import pages as P


def test_embedded_json(spark):
    html = '<script id="__NEXT_DATA__" type="application/json">{"props": {"pageProps": {"n": 3}}}</script>'
    df = spark.createDataFrame([(html,), ("none",)], "html string")
    assert [r.x for r in df.select(P.next_data(F.col("html"), "$.props.pageProps.n").alias("x")).collect()] == ["3", None]


def test_balanced_objects(spark):
    rows = [('x "listingData":{\\"a\\":{\\"b\\":\\"}{\\"},\\"c\\":1} tail',), ('"listingData":{"a":1',), ("nothing",), (None,)]
    got = [r.object for r in P.balanced_objects(spark.createDataFrame(rows, "html string"), "listingData").collect()]
    assert json.loads(got[0]) == {"a": {"b": "}{"}, "c": 1} and got[1:] == [None, None, None]


def test_bullets_and_enrichment(spark):
    b = spark.createDataFrame([("1", ["Chassis WDBSK75F56F107641", "93 Miles", "28k miles shown", "Six-Speed Manual", "Silver paint"]), ("2", [])], "lot string, bullets array<string>")
    got = {r.lot: r for r in P.bullets(b).collect()}
    assert (got["1"].mileage, got["1"].vin, got["1"].transmission, got["1"].color) == (93.0, "WDBSK75F56F107641", "Manual", "Silver") and got["2"].mileage is None
    records = spark.createDataFrame([("1", "1990 A!", 5.0, None, None, None), ("2", "1990 B", 6.0, None, "KEEP1", None)], "lot string, title string, price double, mileage double, vin string, transmission string")
    pages = spark.createDataFrame([("1", "1990 a", 5.0, 10.0, "VIN12", "Manual"), ("2", "1990 B", 7.0, 10.0, "X1234", "Manual")], "lot string, page_title string, page_price double, mileage double, vin string, transmission string")
    out = {r.lot: (r.mileage, r.vin, r.transmission) for r in P.enriched(records, pages).collect()}
    assert out == {"1": (10.0, "VIN12", "Manual"), "2": (None, "KEEP1", None)}


@pytest.mark.parametrize("body,want", [("Held March 22-26, 2024.", (2024, 3, 26)), ("From January 30 - February 2, 2025 in town", (2025, 2, 2)), ("March 1, 2024 and May 5, 2024", (2024, 5, 5)), ("no date", None)])
def test_dates_in_prose(spark, body, want):
    got = spark.createDataFrame([(body,)], "b string").select(P.last_date_in_prose(F.col("b")).alias("x")).first().x
    assert got == (want and datetime.datetime(*want, 12))


def test_slugs_labels_and_sessions(spark):
    rows = [("bat", "https://x/listing/1990-porsche-911-4/", 1990), ("rms", "https://x/lots/2024/1965-ferrari", 1990), ("mecum", "https://x/lots/12/1967-chevrolet-corvette/?a", 1966), ("other", "https://x/1990-a", 1990), ("cab", None, 1)]
    df = spark.createDataFrame(rows, "source string, url string, year int")
    got = df.select(P.slug_parts(F.col("source"), F.col("url")).alias("p"), P.slug_conflict(F.col("source"), F.col("url"), F.col("year")).alias("c")).collect()
    assert [(r.p and r.p.year, r.p and r.p.rest, r.c) for r in got] == [(1990, "porsche-911-4", False), (None, None, False), (1967, "chevrolet-corvette", True), (None, None, False), (None, None, False)]
    one = spark.createDataFrame([("Odometer: 12,000 miles\nEngine: V8", ["2024-01-02T10:00:00Z", "2024-01-03T10:00:00Z", "bad"])], "b string, s array<string>")
    r = one.select(P.labelled(F.col("b"), "Odometer").alias("o"), P.last_session(F.col("s")).alias("e")).first()
    assert r.o == "12,000 miles" and r.e == datetime.datetime(2024, 1, 3, 10)
