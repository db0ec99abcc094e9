"""Worked numbers of the formulas, boundaries, and properties that must hold for any input."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricewright.functions import expr as E
from pricewright.functions import stats as S
from pricewright.functions.desirability import desirability, desirability_reasons


@pytest.fixture(scope="module")
def one(spark):
    base = spark.range(1)
    return lambda c: base.select(c.alias("x")).first().x


def lit(x, kind="double"):
    return F.lit(x).cast(kind)


@pytest.mark.parametrize("x,want", [(2.5, 3), (-2.5, -2), (0.49, 0), (-0.5, 0)])
def test_half_up(one, x, want):
    assert one(E.half_up(lit(x))) == want


@pytest.mark.parametrize(
    "miles,avg,h,age,want",
    [(50_000, 50_000, 5, 10, 100_000), (47_500, 50_000, 5, 10, 100_250), (10_000, 50_000, 9, 30, 133_750), (1, 50_000, 9, 30, 145_000), (400, 50_000, 6, 5, 120_000), (60_000, 50_000, 5, 10, 99_600), (200_000, 50_000, 5, 10, 77_000), (500_000, 50_000, 9, 10, 70_000)],
)
def test_mileage(one, miles, avg, h, age, want):
    assert one(E.mileage_adjusted(lit(100_000), lit(miles), lit(avg), lit(h, "int"), lit(age, "int"))) == want


@pytest.mark.parametrize("n,r2,vol,score,level", [(20, 0.5, 0.1, 1.0, "high"), (3, 0.0, 0.1, 0.33, "low"), (12, 0.45, 0.5, 0.7325, "moderate"), (8, 0.1, 0.0, 0.365, "moderate")])
def test_confidence(one, n, r2, vol, score, level):
    s = E.confidence_score(lit(n, "int"), lit(r2), lit(vol))
    assert one(s) == pytest.approx(score)
    assert one(E.confidence_level(s, lit(n, "int"), lit(vol))) == level


@pytest.mark.parametrize("value,want", [(10_000, 0.1), (25_000, 0.1), (50_000, 0.05), (75_000, 0.0), (112_500, 0.0375), (250_000, 0.06), (900_000, 0.09), (None, 0.0)])
def test_depreciation(one, value, want):
    assert one(E.depreciation(lit(value))) == pytest.approx(want)


@pytest.mark.parametrize("n,span,annual,recent,want", [(2, 400, 0.1, 0.1, "insufficient"), (5, 179, 0.1, 0.1, "insufficient"), (5, 400, 2.5, 0.1, "insufficient"), (5, 400, 0.02, 0.5, "stable"), (5, 400, 0.03, -1, "appreciating"), (5, 400, -0.1, 0.03, "bottomed"), (5, 400, -0.1, 0.0, "approaching"), (5, 400, -0.1, -0.05, "depreciating"), (5, 400, None, None, "insufficient")])
def test_signal(one, n, span, annual, recent, want):
    assert one(E.signal(lit(n, "int"), lit(span), lit(annual), lit(recent))) == want


def test_deal_score_stays_in_bounds(one):
    assert [one(E.deal_score_98(lit(a), lit(100_000))) for a in (100_000, 90_000, 200_000, 50_000)] == [55, 80, 5, 98]


def test_forecast_and_decline(one):
    rate, damp = E.forecast_rate(lit(-0.10), lit(5, "int"), lit(10, "int"), lit(0.9), F.lit("depreciating"), lit(20, "int"), lit(0.3))
    assert one(rate) == pytest.approx(-0.0688) or one(rate) == pytest.approx(0.65 * -0.10 + 0.12 * -0.02 + 0.06 * -0.01 + 0.04 * -0.02)
    assert one(damp) == 0.78
    assert one(E.projected(lit(100_000), lit(-0.1), lit(0.5), 2, lit(40_000))) == 85_500
    assert one(E.projected(lit(100_000), lit(-0.9), lit(1.0), 3, lit(40_000))) == 40_000
    d = one(E.decline(lit(100_000), lit(-0.01), lit(0.78), lit(40_000)))
    assert (d.status, d.bottom_years, d.bottom_value) == ("flattened", 0.3, 99_750)
    assert one(E.decline(lit(100_000), lit(0.0), lit(0.78), lit(40_000))).status == "not_declining"
    assert one(E.decline(lit(100_000), lit(-0.9), lit(1.0), lit(90_000))).status == "floor_reached"


def test_shrinkage_and_t(one):
    assert one(E.shrunk(lit(0.5), lit(0.1), lit(25, "int"))) == pytest.approx(0.3)
    assert one(E.shrunk(lit(None), lit(0.1), lit(25, "int"))) is None
    assert [one(E.t_critical(lit(n, "int"))) for n in (0, 1, 11, 60, 61)] == [6.31, 6.31, 1.75, 1.67, 1.65]


@pytest.mark.parametrize("sales,listings,verdict", [(3, 5, "THIN MARKET"), (10, 1, "TIGHT SUPPLY"), (20, 4, "SELLER'S MARKET"), (4, 3, "BALANCED"), (4, 10, "BUYER'S MARKET")])
def test_liquidity(one, sales, listings, verdict):
    assert one(E.liquidity(lit(sales, "int"), lit(listings, "int"))[0]) == verdict


@pytest.mark.parametrize("raw,vin,valid", [("wdb-sk75f56f107641", "WDBSK75F56F107641", True), ("VIN", None, False), ("0000000", None, False), ("118.000 002763", "118000002763", True), ("ABCDEFG", None, False), ("1FTIOQ22G96510437", "1FTIOQ22G96510437", False), (None, None, False), ("1234", None, False)])
def test_vin(one, raw, vin, valid):
    assert one(E.normal_vin(lit(raw, "string"))) == vin and one(E.valid_vin(lit(raw, "string"))) is valid


def test_vin_years(one):
    assert one(E.vin_years(F.lit("WDDAJ76F96M001144"))) == [2006, 2036]
    assert one(E.vin_year_plausible(F.lit("WDDAJ76F96M001144"), lit(2012, "int"))) is False
    assert one(E.vin_year_plausible(F.lit("short1"), lit(2012, "int"))) is True


@pytest.mark.parametrize("url,want", [("HTTPS://A.b/C/?x=1#y", "https://a.b/c"), ("", None), (None, None), ("///", None), ("a#b?c", "a")])
def test_canonical_url(one, url, want):
    assert one(E.canonical_url(lit(url, "string"))) == want


def pair(spark, **changed):
    base = {"source": "bat", "url": "https://x/1", "title": "1990 Porsche 911", "price_usd": 100_000.0, "sold_at": datetime.datetime(2024, 1, 1), "vin_normal": None, "mileage": 30_000.0}
    schema = ", ".join(f"{p}{c} {t}" for p in ("a_", "b_") for c, t in (("source", "string"), ("url", "string"), ("title", "string"), ("price_usd", "double"), ("sold_at", "timestamp"), ("vin_normal", "string"), ("mileage", "double")))
    row = [*base.values(), *(base | {"source": "mecum", "url": "https://y/2"} | changed).values()]
    return spark.createDataFrame([tuple(row)], schema).select(E.duplicate_score("a_", "b_").alias("x")).first().x


def test_duplicate_score(spark):
    assert pair(spark) == pytest.approx(1.0)
    assert pair(spark, price_usd=108_000.0) == pytest.approx(0.85)
    assert pair(spark, source="bat", url="HTTPS://x/1/?q", price_usd=1.0) == 1.0
    assert pair(spark, vin_normal="A" * 17) == pytest.approx(1.0)
    assert pair(spark, sold_at=None, mileage=None, title=None) == pytest.approx(0.45)


@pytest.mark.parametrize("model,make,value,msrp,age,want", [("Camry", "Toyota", 50_000.0, None, 5, 5), ("F40", "Ferrari", 1e6, None, 30, 10), ("F40", "Ferrari", 1e6, None, 30, 10), ("Cayenne", "Porsche", 25_000.0, None, 5, 3), ("Custom", "Ford", 50_000.0, None, 5, 8), ("M3 CSL", "BMW", 50_000.0, None, 5, 9)])
def test_desirability(one, model, make, value, msrp, age, want):
    assert one(desirability(F.lit(model), F.lit(make), lit(value), lit(msrp), lit(age, "int"))) == want


def test_desirability_without_hindsight(one):
    args = (F.lit("DB12 manual"), F.lit("Aston Martin"), lit(210_000), lit(100_000), lit(25, "int"))
    assert one(desirability(*args)) == 7 and one(desirability(*args, curated=False)) == 10
    assert one(desirability_reasons(*args)) == ["Manual transmission", "Premium segment", "Trading well above MSRP", "Classic age — peak collectibility", "Strong collector brand"]


def test_regressions_of_constant_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 3.0), (2, 1.0, 2.0), (2, 2.0, 2.0), (3, 1.0, 1.0), (4, 1.0, 2.0), (4, 2.0, 4.0), (4, 3.0, 5.0)], "k int, x double, y double")
    x, y = F.col("x"), F.col("y")
    got = {r.k: r for r in df.groupBy("k").agg(S.ols_slope(y, x).alias("b"), S.ols_r2(y, x).alias("r2"), S.slope_error(y, x).alias("se"), S.variation(y).alias("v")).collect()}
    assert (got[1].b, got[1].r2, got[1].se) == (0.0, 0.0, None)
    assert (got[2].b, got[2].r2) == (0.0, 0.0) and got[3].v == 0.0
    assert got[4].b == pytest.approx(1.5) and got[4].r2 == pytest.approx(0.964286, abs=1e-6) and got[4].se == pytest.approx(0.288675, abs=1e-6)


def test_trimmed_mean(one):
    entry = lambda v, w: F.struct(lit(float(v)).alias("value"), lit(w).cast("long").alias("weight"))
    values = F.array(*[entry(x, 1) for x in (100, 1, 2, 3, 4, 5, 6, 7, 8, -90)])
    assert one(S.trimmed_mean(values, lit(0.1))) == pytest.approx(4.5) and one(S.trimmed_mean(values, lit(0.0))) == pytest.approx(4.6)
    assert one(S.trimmed_mean(F.array().cast("array<struct<value:double,weight:bigint>>"), lit(0.1))) is None
    weighted = F.array(entry(5, 3), entry(100, 4), entry(-1, 3))  # -1 -1 -1 5 5 5 100 100 100 100
    assert one(S.trimmed_mean(weighted, lit(0.2))) == pytest.approx((-1 + 15 + 200) / 6)


def test_windows_and_json(one):
    at = lambda x: F.lit(x).cast("timestamp")
    day, last = at("2024-01-02"), at("2024-01-31")
    assert one(E.within(at("2024-01-31 23:59:59"), day, last)) and not one(E.within(at("2024-02-01"), day, last)) and not one(E.within(at(None), day, last))
    assert one(E.year_within(F.lit("sale-of-2024-x1999"), day, last)) and not one(E.year_within(F.lit("no year"), day, last)) and not one(E.year_within(F.lit(None).cast("string"), day, last))
    assert one(E.aged_at_most(at("2024-01-01"), last, 30)) and not one(E.aged_at_most(at("2024-02-02"), last, 30))
    lo, hi = E.recent_window(day, last, at("2024-01-20"), 5)
    assert str(one(lo))[:10] == "2024-01-15" and str(one(hi))[:10] == "2024-01-20"
    assert one(E.json_or_null(F.array())) is None and one(E.json_or_null(F.array(F.lit(1)))) == "[1]"
    assert one(E.json_list(F.lit("[1, 2]"), "int")) == [1, 2] and one(E.json_list(F.lit(None).cast("string"))) == []
    assert one(E.lacks(F.lit('{"a": 1}'), "$.b")) and not one(E.lacks(F.lit('{"a": 1}'), "$.a"))
    assert str(one(E.event_end(F.lit('{"startDate": "2024-08-15", "endDate": "2024-08-17T10:00"}')))) == "2024-08-17"
    assert str(one(E.event_end(F.lit('[{"name": "x"}, {"startDate": "2023-08-15"}]')))) == "2023-08-15" and one(E.event_end(F.lit("not json"))) is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text("abc d", max_size=12), st.text("abc d", max_size=12)), min_size=1, max_size=8))
def test_trigram_similarity_is_symmetric_and_bounded(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    s = lambda p, q: E.set_similarity(E.trigrams(F.col(p)), E.trigrams(F.col(q)))
    for r in df.select(s("a", "b").alias("x"), s("b", "a").alias("y"), s("a", "a").alias("z"), "a").collect():
        assert r.x == r.y and 0 <= r.x <= 1 and r.z in (0.0, 1.0)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.floats(-1, 1), st.integers(0, 50)), min_size=2, max_size=10))
def test_shrinkage_grows_with_evidence(spark, rows):
    df = spark.createDataFrame(rows, "e double, df int")
    for r in df.select("e", E.shrunk(F.col("e"), F.lit(0.0), F.col("df")).alias("a"), E.shrunk(F.col("e"), F.lit(0.0), F.col("df") + 1).alias("b")).collect():
        assert abs(r.a) <= abs(r.b) + 1e-12 and abs(r.b) <= abs(r.e) + 1e-12
