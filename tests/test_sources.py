import datetime
import json

import pytest
from pyspark.sql import functions as F

from pricewright.sources import adapters as A
from pricewright.sources import landed


def only(df):
    r = df.first()
    return r.kind, r.reason, r.record


BAT = "id long, url string, title string, sold_text string, sold_text_timestamp long, country_code string, thumbnail_url string"
CAB = "id string, title string, sub_title string, status string, sale_amount double, current_bid double, auction_end string, mileage string"
RMS = "id string, publicName string, link string, value string, valueType string, sold boolean, header string, sold_at string"
CARD = "href string, cardText string, status string, sold_at string"


def test_bat(spark):
    kind, _, r = only(A.bat(spark.createDataFrame([(None, "https://x/listing/1990-foo/?a=1", "1990 <i>Foo</i>", "Bid to <b>EUR 12,345</b> on 3/5/2024", None, "DE", "i")], BAT)))
    assert (kind, r.lot, r.title, r.price, r.currency, r.price_usd, r.status, r.non_us_sale) == ("sale", "1990-foo", "1990 Foo", 12_345.0, "EUR", None, "reserve_not_met", True)
    assert r.sold_at == datetime.datetime(2024, 3, 5, 12)
    assert only(A.bat(spark.createDataFrame([(1, "u", "t", "Withdrawn", None, None, None)], BAT)))[:2] == ("skip", "no result line")


@pytest.mark.parametrize(
    "change,want",
    [({}, None), ({"id": None}, "no id"), ({"title": " "}, "no title"), ({"status": "odd"}, 'unrecognised status "odd" — refusing to guess an outcome'), ({"sale_amount": None, "current_bid": None}, "no price"), ({"auction_end": None}, "no auction_end date"), ({"auction_end": "soon"}, "unparseable date")],
)
def test_cab_gates_in_order(spark, change, want):
    base = {"id": "a", "title": "T", "sub_title": "6-speed manual", "status": "Sold-After", "sale_amount": 26250.0, "current_bid": None, "auction_end": "2024-03-05T10:00:00Z", "mileage": "48,000 Kilometers"}
    kind, reason, r = only(A.cab(spark.createDataFrame([tuple((base | change).values())], CAB)))
    assert reason == want
    if not want:
        assert (kind, r.status, r.mileage, r.transmission) == ("sale", "sold_after", 29_826.0, "Manual")


@pytest.mark.parametrize("text,want", [("93 Miles", 93), ("28k Miles Shown", 28_000), ("146,900 Miles", 146_900), ("0 miles", None), ("TMU 5,000 miles", None), ("no odometer", None), (None, None)])
def test_miles(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(A.miles("t").alias("x")).first().x == want


def test_rms(spark):
    row = ("r1", "1960 Ferrari", "/lots/x?y", "€1,500,000", "Sold", True, "Monterey", "2024-08-17")
    kind, _, r = only(A.rms(spark.createDataFrame([row], RMS)))
    assert (kind, r.price, r.currency, r.url, r.non_us_sale) == ("sale", 1_500_000.0, "EUR", "https://rmsothebys.com/lots/x", True)
    ask = ("r2", "1960 Ferrari", "/lots/x", "$900,000 USD", "Asking", False, "Private", None)
    assert only(A.rms(spark.createDataFrame([ask], RMS)))[0] == "listing"
    assert only(A.rms(spark.createDataFrame([(*row[:6], "Car Memorabilia", None)], RMS)))[1].startswith("dedicated memorabilia")
    assert only(A.rms(spark.createDataFrame([(*row[:7], None)], RMS)))[1] == A.NO_DATE
    assert only(A.rms(spark.createDataFrame([("r", "T", "l", "$1", "Not sold", False, "", None)], RMS)))[1].startswith("not a sale")


@pytest.mark.parametrize(
    "href,card,date,reason",
    [("/lots/123/1967-chevrolet-corvette-l88/", "Sold $143,500", "March 26, 2024", None), ("/lots/123/1967-neon-sign/", "$5,000", "2024-01-01", "automobilia/memorabilia"), ("/lots/1/x-y", "The Bid Goes On $5", "2024-01-01", "reserve not met (Bid Goes On)"), ("/lots/1/x-y", "$1", "2024-01-01", "sentinel price ($1 = undisclosed/charity)"), ("/lots/1/x-y", "n/a", "2024-01-01", "no price on card"), ("/lots/1/x-y", "$9,000", None, A.NO_DATE), ("/other", "$9", None, "unrecognised lot URL")],
)
def test_mecum(spark, href, card, date, reason):
    kind, why, r = only(A.mecum(spark.createDataFrame([(href, card, None, date)], CARD)))
    assert why == reason
    if not reason:
        assert r.title == "1967 Chevrolet Corvette L88" and r.sold_at == datetime.datetime(2024, 3, 26, 12)


def test_bonhams(spark):
    schema = "department struct<code:string>, title string, status string, price struct<hammerPremium:double,hammerPrice:double>, hammerTime struct<datetime:string>, currency struct<iso_code:string>, country struct<code:string>, id string, lotId string, slug string, auctionId string"
    row = (("MOT-CAR",), "2012 Mercedes-Benz SLS VIN. WDDAJ76F96M001144", "sold", (None, 90_000.0), ("2024-05-01T10:00:00Z",), ("GBP",), None, None, "178", "sls", "25719")
    _, _, r = only(A.bonhams(spark.createDataFrame([row], schema)))
    assert (r.lot, r.price, r.price_usd, r.vin, r.non_us_sale, r.status) == ("25719-178", 90_000.0, None, None, True, "sold")
    assert only(A.bonhams(spark.createDataFrame([(("MOT-BIK",), *row[1:])], schema)))[1] == "department MOT-BIK, not cars"
    bought_in = only(A.bonhams(spark.createDataFrame([(row[0], "1990 X1", "BI", (None, None), *row[4:])], schema)))[2]
    assert bought_in.status == "reserve_not_met" and bought_in.reserve_not_met


def test_gooding_code_and_sentinel(spark):
    schema = "slug string, salePrice string, privateSalesPrice boolean, item struct<__typename:string,title:string>, sold_at string, currency string"
    item = ("ContentfulVehicle", "1955 Jaguar D-Type (PB26)")
    assert only(A.gooding(spark.createDataFrame([("s", "5000000", None, item, "2024-01-01", None)], schema)))[2].title == "1955 Jaguar D-Type"
    assert only(A.gooding(spark.createDataFrame([("s", "x", True, item, "2024-01-01", None)], schema)))[1].startswith("private sale")
    assert only(A.gooding(spark.createDataFrame([("s", None, None, item, "2024-01-01", None)], schema)))[1].startswith("no result")


def test_pages(spark):
    schema = "url string, html string, sold_at string"
    estimate = ("https://b/vehicles/ab_1/x", "<h1>1990 A &amp; B</h1><div class=price-row>Estimate $100,000 - $120,000</div>", None)
    kind, _, r = only(A.broadarrow(spark.createDataFrame([estimate], schema)))
    assert (kind, r.title, r.price, r.estimate_low) == ("listing", "1990 A & B", 110_000.0, 100_000.0)
    sale = ("https://b/vehicles/ab_1/x", "<h1>1990 A</h1><div class=price-row>$50,000</div>", "2024-01-02")
    assert only(A.broadarrow(spark.createDataFrame([sale], schema)))[0] == "sale"


@pytest.mark.parametrize("text,kind,status", [("Sold for $42,265 on 08/20/26", "sale", "sold"), ("Sold after auction: $5,000 on 8/2/2026", "sale", "sold_after"), ("Bid to $9,000 on 8/1/2026", "listing", "bid_to"), ("Withdrawn on 8/1/2026", "listing", "withdrawn"), ("Reserve not met High bid: $7,000", "listing", "reserve_not_met"), ("Current bid $5,000 Ending March 5, 2027", "listing", "live"), ("Ending March 5, 2025", "listing", "ended"), ("hello", "listing", "unknown")])
def test_hagerty_outcomes(spark, text, kind, status):
    df = spark.createDataFrame([("https://h/marketplace/auction/abc", "1990 T", text)], "url string, title string, text string").withColumn("as_of", F.lit("2026-09-01").cast("timestamp"))
    got, reason, r = only(A.hagerty(df))
    assert reason is None and got == kind and status in (r.status, r.listing_status)


def test_api_cards_leads_and_listings(spark):
    api = spark.createDataFrame([(7, "1970 Cuda", 143_500.0, "2024-01-20T12:00:00", True, None, "scottsdale", "1970-cuda")], "item_id long, title string, price_decimal double, run_datetime string, is_sold boolean, is_canceled boolean, event_slug string, slug string")
    assert only(A.barrett_jackson(api))[2].url.endswith("/docket/vehicle/1970-cuda-7")
    card = ("/x/docket/vehicle/1970-plymouth-cuda-260", "SOLD $143,500", None, "2024-01-20")
    assert only(A.barrett_jackson_cards(spark.createDataFrame([card], CARD)))[2].title == "1970 Plymouth Cuda"
    assert only(A.barrett_jackson_cards(spark.createDataFrame([("/x/docket/automobilia/sign-2", "SOLD $9", None, "2024")], CARD)))[1] == "automobilia docket path"
    lead = spark.createDataFrame([("https://www.classic.com/veh/abc?x", "T", "Sold", "$10,000", "2024-01-02", "28k mi", "WDB12345678", None)], "url string, title string, outcome string, price string, date string, mileage string, vin_raw string, upstream_url string")
    kind, _, r = only(A.classic(lead))
    assert kind == "lead" and r.price is None and json.loads(r.extra)["reported_price_usd"] == 10_000
    dupont = spark.createDataFrame([("u", 5, 2020, "Ferrari", "F8", "$300,000".replace("$", ""), "1,200", "000000000", False)], "url string, listingId long, year int, make string, model string, price string, mileage string, vin string, isSold boolean")
    kind, _, r = only(A.dupont(dupont))
    assert (kind, r.title, r.mileage, r.vin, r.listing_status) == ("listing", "2020 Ferrari F8", 1200.0, None, "live")
    sms = spark.createDataFrame([((1990, "A", "B", "sold", "s-1"), (5000.0,), "2024-01-01T00:00:00Z", 3)], "vehicleData struct<year:int,make:string,model:string,vehicleStatus:string,slug:string>, bidDetails struct<value:double>, soldDate string, lotNumber int")
    assert only(A.sms(sms))[2].title == "1990 A B"
    assert A.split_kinds(A.sms(sms), "sale").count() == 1


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "n": {"x": 2}}, {"id": "2"}]))
    (tmp_path / "b.json").write_text('[{"id": "3"')  # truncated
    (tmp_path / "c.json").write_text('{"id": "4"}')
    (tmp_path / "a.state.json").write_text('[{"id": "5"}]')
    rows = landed.harvested(spark, str(tmp_path), "id string, n struct<x:int>").orderBy("ordinal").collect()
    assert [(r.ordinal, r.id, r.n and r.n.x) for r in rows] == [(0, "1", 2), (1, "2", None)]


def test_reference_rates(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Date, USD, GBP,\n2024-01-02, 1.1, 0.9,\n2024-01-03, N/A, 0.9,\nbad, 1, 1,\n2024-01-04, 1.2, -1,\n")
    got = {(str(r.rate_date), r.currency): r.per_eur for r in landed.reference_rates(spark, str(tmp_path / "r.csv")).collect()}
    assert got == {("2024-01-02", "USD"): 1.1, ("2024-01-02", "GBP"): 0.9, ("2024-01-04", "USD"): 1.2}
