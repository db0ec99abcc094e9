"""Raw records of each source into (kind, reason, record): sale, listing, lead or skip.

A source is a list of gates, of which the first that fails gives the reason, a kind, and the
columns of the record that it fills. Each is one projection; no Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as E
from .landed import RECORD

KM = 0.621371
NO_DATE = "no auction date resolved — would be invisible to all trend maths"
#: Fixed values (patterns, any case): objects that are sold beside cars.
OBJECTS = r"(?i)\b(?:sign|neon|poster|pedal car|memorabilia|automobilia|go-?kart|jukebox|gas pump|clock|banner|jacket|helmet|literature|toolbox|trailer lot|display|model car)s?\b"
FIELDS = [f.strip().split(" ") for f in RECORD.split(",")]


def text(c) -> Column:
    """Trimmed text without tags and repeated white space, never null."""
    x = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), "<[^>]+>", " "), r"\s+", " "))


def first(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null if there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def number(c: Column) -> Column:
    return F.regexp_replace(c, ",", "").try_cast("double")


def currency_of(symbol: Column) -> Column:
    return F.when(symbol == "€", "EUR").when(symbol == "£", "GBP").when(symbol == "¥", "JPY").when(symbol == "$", "USD")


def miles(c) -> Column:
    """Miles of "12,345 Miles", "30k km", ...; zero and unknown mileages are null."""
    t = text(c)
    n = number(first(t, r"(?i)([\d][\d,.]*)\s*k?[\s-]*(?:miles?|mi|kilometers?|km)\b"))
    n = n * F.when(t.rlike(r"(?i)\d\s*k[\s-]*(?:mile|mi\b|km|kilom)"), 1000).otherwise(1)
    n = F.when(t.rlike(r"(?i)\d\s*k?[\s-]*(?:km|kilom)"), E.half_up(n * KM).cast("double")).otherwise(n)
    return F.when((n > 0) & ~t.rlike(r"(?i)\bTMU\b|true mileage unknown"), n)


def gearbox(c) -> Column:
    t = text(c)
    return F.when(t.rlike("(?i)manual") & t.rlike("(?i)automatic"), None).when(t.rlike("(?i)manual"), "Manual").when(t.rlike("(?i)automatic|dct|pdk|tiptronic"), "Automatic")


def slug_title(slug: Column) -> Column:
    """Title from a url's slug: words capitalised, codes in capitals."""
    word = lambda w: F.when(w.rlike(r"^\d+$|^[a-z]?\d"), F.upper(w)).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2))))
    return F.array_join(F.transform(F.filter(F.split(slug, "-"), lambda w: w != ""), word), " ")


def timestamp(c) -> Column:
    """ISO (a naive one is UTC), "March 5, 2024" and m/d/y dates; dates alone are at noon."""
    t = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    noon = F.expr("interval 12 hours")
    prose = first(t, r"\b([A-Z][a-z]+ \d{1,2},? \d{4})\b")
    slash = first(t, r"\b(\d{1,2}/\d{1,2}/\d{4})\b")
    short = first(t, r"\b(\d{1,2}/\d{1,2}/\d{2})\b(?!\d)")
    iso = first(t, r"\b(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}\S*)")
    day = first(t, r"\b(\d{4}-\d{2}-\d{2})\b")
    return F.coalesce(
        F.try_to_timestamp(iso), F.try_to_timestamp(day, F.lit("yyyy-MM-dd")) + noon, F.try_to_timestamp(F.replace(prose, F.lit(","), F.lit("")), F.lit("MMMM d yyyy")) + noon,
        F.try_to_timestamp(slash, F.lit("M/d/yyyy")) + noon, F.try_to_timestamp(short, F.lit("M/d/yy")) + noon,
    )


def adapted(raw: DataFrame, source: str, gates: Sequence[tuple[Column, str | Column]], record: Mapping[str, Column], kind: Column | str = "sale") -> DataFrame:
    """``raw`` as (kind, reason, record). A gate is (what must hold, reason if it does not); null counts as failed."""
    reason = reduce(lambda rest, g: F.when(~F.coalesce(g[0], F.lit(False)), g[1]).otherwise(rest), reversed(gates), F.lit(None).cast("string"))
    filled = {"source": F.lit(source), "currency": F.lit("USD"), "non_us_sale": F.lit(False), "reserve_not_met": F.lit(False)} | dict(record)
    filled.setdefault("price_usd", F.when(filled["currency"] == "USD", filled.get("price", F.lit(None))))
    struct = F.struct(*[filled.get(n, F.lit(None)).cast(t).alias(n) for n, t in FIELDS])
    says = F.lit(kind) if isinstance(kind, str) else kind
    out = raw.withColumn("reason", reason)
    return out.select(F.when(F.col("reason").isNotNull(), "skip").otherwise(says).alias("kind"), "reason", F.when(F.col("reason").isNull(), struct).alias("record"))


def split_kinds(out: DataFrame, kind: str) -> DataFrame:
    return out.filter(F.col("kind") == kind).select("record.*")


def bat(raw: DataFrame) -> DataFrame:
    """List items: id, url, title, sold_text (html), sold_text_timestamp, country_code, thumbnail_url."""
    t = text("sold_text")
    result = r"(?i)(Sold for|Bid to)\s+([A-Z]{3})?\s*\$?([\d,]+)\s+on\s+(\d{1,2}/\d{1,2}/\d{4})"
    currency = F.coalesce(first(t, result, 2), F.lit("USD"))
    lot = F.coalesce(F.col("id").cast("string"), first(F.col("url"), r"/listing/([^/?#]+)"))
    at = F.coalesce(F.timestamp_seconds("sold_text_timestamp"), timestamp(first(t, result, 4)))
    abroad = F.coalesce(F.col("country_code") != "US", F.lit(False)) | (currency != "USD")
    unsold = ~t.rlike("(?i)sold for")
    return adapted(raw, "bat", [(t.rlike(result), "no result line"), (lot.isNotNull(), "no lot id")], {"lot": lot, "url": F.substring_index("url", "?", 1), "title": text("title"), "sold_at": at, "price": number(first(t, result, 3)), "currency": currency, "non_us_sale": abroad, "reserve_not_met": unsold, "status": F.when(unsold, "reserve_not_met").otherwise("sold"), "image_url": F.col("thumbnail_url")})


def cab(raw: DataFrame) -> DataFrame:
    """Auctions: id, title, sub_title, status, sale_amount, current_bid, auction_end, mileage."""
    said = F.regexp_replace(F.lower(text("status")), "[-_ ]", "")
    status = F.when(said == "sold", "sold").when(said == "soldafter", "sold_after").when(said.isin("reservenotmet", "unsold", "notsold"), "reserve_not_met")
    price = F.coalesce(F.col("sale_amount").cast("double"), F.col("current_bid").cast("double"))
    at = timestamp("auction_end")
    gates = [(F.col("id").isNotNull(), "no id"), (text("title") != "", "no title"), (status.isNotNull(), F.concat(F.lit('unrecognised status "'), F.coalesce("status", F.lit("")), F.lit('" — refusing to guess an outcome'))), (price > 0, "no price"), (F.col("auction_end").isNotNull(), "no auction_end date"), (at.isNotNull(), "unparseable date")]
    return adapted(raw, "cab", gates, {"lot": F.col("id"), "url": F.concat(F.lit("https://carsandbids.com/auctions/"), F.col("id")), "title": text("title"), "sold_at": at, "price": price, "mileage": miles("mileage"), "transmission": gearbox("sub_title"), "status": status, "reserve_not_met": status == "reserve_not_met"})


def rms(raw: DataFrame) -> DataFrame:
    """Search lots: id, publicName, link, value, valueType, sold, header, and the auction's sold_at; asks are listings."""
    value = text("value")
    shape = r"([€£$¥])?\s*([\d][\d,]*)\s*([A-Z]{3})?"
    amount = F.when(~value.rlike("(?i)request|refer|n/?a"), number(first(value, shape, 2)))
    currency = F.coalesce(first(value, shape, 3), currency_of(first(value, shape, 1)), F.lit("USD"))
    kind = F.trim(F.coalesce("valueType", F.lit("")))
    sold, ask = F.coalesce(F.col("sold"), F.lit(False)) & kind.rlike("(?i)^sold$"), kind.rlike("(?i)asking")
    link = F.coalesce("link", F.lit(""))
    gates = [(text("publicName") != "", "no title"), (~text("header").rlike(r"(?i)\bmemorabilia\b"), "dedicated memorabilia auction, not vehicles"), (sold | ask, F.concat(F.lit('not a sale (valueType="'), kind, F.lit('")'))), (ask | (amount > 0), "sold but unparseable value"), (ask | F.col("sold_at").isNotNull(), NO_DATE)]
    record = {"lot": F.coalesce(F.col("id").cast("string"), first(link, r"/lots/([^/?#]+)")), "url": F.substring_index(F.when(link.startswith("http"), link).otherwise(F.concat(F.lit("https://rmsothebys.com"), link)), "?", 1), "title": text("publicName"), "sold_at": F.when(sold, timestamp("sold_at")), "price": amount, "currency": currency, "non_us_sale": F.coalesce(currency != "USD", F.lit(False)), "status": F.when(sold, "sold"), "listing_type": F.when(ask, "classified"), "listing_status": F.when(ask, "live"), "price_type": F.when(ask, "asking"), "is_active": ask}
    return adapted(raw, "rms", gates, record, F.when(sold, "sale").otherwise("listing"))


def mecum(raw: DataFrame) -> DataFrame:
    """Cards: href, cardText, and the event's sold_at."""
    href, card = F.coalesce("href", F.lit("")), F.coalesce("cardText", F.lit(""))
    lot, title = first(href, r"/lots/([^/]+)/[^/?#]+"), slug_title(F.regexp_extract(href, r"/lots/[^/]+/([^/?#]+)", 1))
    price = number(first(card, r"\$\s?([\d][\d,]*)"))
    gates = [(lot.isNotNull(), "unrecognised lot URL"), (title != "", "no title derivable from slug"), (~title.rlike(OBJECTS), "automobilia/memorabilia"), (~card.rlike("(?i)bid goes on"), "reserve not met (Bid Goes On)"), (price > 0, "no price on card"), (price > 1, "sentinel price ($1 = undisclosed/charity)"), (F.col("sold_at").isNotNull(), NO_DATE)]
    return adapted(raw, "mecum", gates, {"lot": lot, "url": F.substring_index(F.when(href.startswith("http"), href).otherwise(F.concat(F.lit("https://www.mecum.com"), href)), "?", 1), "title": title, "sold_at": timestamp("sold_at"), "price": price, "status": F.lit("sold")})


def bonhams(raw: DataFrame) -> DataFrame:
    """Lots: department {code}, title, status, price {hammerPremium, hammerPrice}, hammerTime {datetime}, currency {iso_code}, country {code}, id, lotId, slug, auctionId."""
    title, status, dept = text("title"), F.upper(text("status")), F.coalesce("department.code", F.lit("unknown"))
    price = F.coalesce(F.col("price.hammerPremium").cast("double"), F.col("price.hammerPrice").cast("double"), F.lit(0.0))
    currency = F.coalesce("currency.iso_code", F.lit("USD"))
    vin = F.upper(first(title, r"(?i)\bVIN\b\.?\s*([A-HJ-NPR-Z0-9]{17})\b"))
    year = first(title, r"\b(1[89]\d{2}|20[0-4]\d)\b").cast("int")
    sold = status == "SOLD"
    gates = [(dept == "MOT-CAR", F.concat(F.lit("department "), dept, F.lit(", not cars"))), (title != "", "no title"), (status.isin("SOLD", "BI"), F.concat(F.lit("status "), status, F.lit(" — not a concluded outcome"))), (~sold | (price > 0), "marked SOLD but carries no usable price"), (F.col("hammerTime.datetime").isNotNull(), "no date — would be invisible to all trend maths")]
    record = {"lot": F.coalesce(F.col("id").cast("string"), F.concat_ws("-", "auctionId", "lotId")), "url": F.concat(F.lit("https://cars.bonhams.com/auction/"), F.col("auctionId"), F.lit("/lot/"), F.col("lotId"), F.lit("/"), F.coalesce("slug", F.lit("")), F.when(F.coalesce("slug", F.lit("")) != "", "/").otherwise("")), "title": title, "sold_at": timestamp("hammerTime.datetime"), "price": price, "currency": currency, "price_usd": F.when(sold & (currency == "USD"), price), "vin": F.when(year.isNull() | E.vin_year_plausible(vin, year), vin), "non_us_sale": F.coalesce(F.col("country.code") != "US", currency != "USD"), "status": F.when(sold, "sold").otherwise("reserve_not_met"), "reserve_not_met": ~sold}
    return adapted(raw, "bon", gates, record)


def gooding(raw: DataFrame) -> DataFrame:
    """Lots: slug, salePrice, privateSalesPrice, item {__typename, title}, and sold_at, currency."""
    code = r"\s*\((?:\d{1,3}|(?:PB|FL|RP|SL|UK|VA|PM|PS)\d{0,2}(?:[\s-]\d{1,3})?|O\d{2}[A-Z](?:[\s-]\d{1,3})?)\)\s*$"
    title, price = F.trim(F.regexp_replace(F.trim(F.coalesce("item.title", F.lit(""))), code, "")), number(F.col("salePrice").cast("string"))
    currency = F.coalesce("currency", F.lit("USD"))
    gates = [(F.col("item.__typename") == "ContentfulVehicle", "not a vehicle lot"), (title != "", "no title"), (~F.coalesce(F.col("privateSalesPrice"), F.lit(False)), "private sale, price undisclosed (salePrice is a non-numeric sentinel)"), (F.col("salePrice").isNotNull(), "no result recorded (unsold / reserve not met / withdrawn)"), (price > 0, "unparseable salePrice"), (F.col("sold_at").isNotNull(), NO_DATE)]
    return adapted(raw, "good", gates, {"lot": F.col("slug"), "url": F.concat(F.lit("https://www.goodingco.com/lot/"), F.col("slug")), "title": title, "sold_at": timestamp("sold_at"), "price": price, "currency": currency, "non_us_sale": currency != "USD", "status": F.lit("sold")})


def broadarrow(raw: DataFrame) -> DataFrame:
    """Pages: url, html, and sold_at. An estimate makes a listing at its middle, a price a sale."""
    html = F.coalesce("html", F.lit(""))
    lot = first(F.col("url"), r"(?i)/vehicles/([a-z0-9]+_[a-z0-9]+)/")
    title = F.trim(F.regexp_replace(F.replace(F.replace(F.regexp_extract(html, r"(?s)<h1>\s*(.*?)\s*</h1>", 1), F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&")), r"\s+", " "))
    block = F.when(F.instr(html, "price-row") > 0, F.substr(html, F.instr(html, "price-row"), F.lit(700)))
    estimated = block.rlike("(?i)estimate")
    span = r"\$([\d,]+)\s*-\s*\$?([\d,]+)"
    low, high, price = number(first(block, span, 1)), number(first(block, span, 2)), number(first(block, r"\$([\d,]+)"))
    currency = F.coalesce(first(html, r"id='original_currency'[^>]*>([A-Z]{3})<"), F.lit("USD"))
    gates = [(lot.isNotNull(), "no lot id in URL"), (title != "", "no title"), (block.isNotNull(), "no price-row on page"), (~estimated | ((low > 0) & (high > 0)), "estimate label present but no parseable range"), (estimated | (price > 0), "no price found (unsold or not yet posted)"), (estimated | F.col("sold_at").isNotNull(), NO_DATE)]
    record = {"lot": lot, "url": F.col("url"), "title": title, "sold_at": F.when(~estimated, timestamp("sold_at")), "price": F.when(estimated, E.half_up((low + high) / 2)).otherwise(price), "currency": currency, "non_us_sale": currency != "USD", "vin": first(html, r'(?i)"vehicleIdentificationNumber"\s*:\s*"([A-HJ-NPR-Z0-9]{6,17})"'), "status": F.when(~estimated, "sold"), "estimate_low": low, "estimate_high": high, "is_active": estimated, "listing_type": F.when(estimated, "auction"), "listing_status": F.when(estimated, "live"), "price_type": F.when(estimated, "estimate")}
    return adapted(raw, "broadarrow", gates, record, F.when(estimated, "listing").otherwise("sale"))


def sms(raw: DataFrame) -> DataFrame:
    """Auctions: vehicleData {year, make, model, vehicleStatus, slug}, bidDetails {value}, soldDate, lotNumber."""
    price, v = F.col("bidDetails.value").try_cast("double"), "vehicleData"
    title = F.trim(F.regexp_replace(F.concat_ws(" ", f"{v}.year", f"{v}.make", f"{v}.model"), r"\s+", " "))
    lot = F.coalesce(F.col(f"{v}.slug"), F.col("lotNumber").cast("string"))
    gates = [(F.col(f"{v}.vehicleStatus") == "sold", "not sold"), (price > 0, "unparseable bid value"), (F.col("soldDate").isNotNull(), "no sold date"), (title != "", "no title"), (lot.isNotNull(), "no stable lot id")]
    return adapted(raw, "sms", gates, {"lot": lot, "title": title, "sold_at": timestamp("soldDate"), "price": price, "status": F.lit("sold")})


def dupont(raw: DataFrame) -> DataFrame:
    """Pages whose listing data were cut out as JSON: url, listingId, year, make, model, price, mileage, vin, isSold. All are listings."""
    sold = F.coalesce(F.col("isSold").cast("string").rlike("(?i)^(true|sold)$"), F.lit(False))
    title, price = F.trim(F.regexp_replace(F.concat_ws(" ", "year", "make", "model"), r"\s+", " ")), number(F.col("price").cast("string"))
    gates = [(title != "", "no title"), (F.col("listingId").isNotNull(), "no stable lot id"), (sold | (price > 0), "no price posted (call for price / not disclosed)")]
    record = {"lot": F.col("listingId"), "url": F.col("url"), "title": title, "price": F.when(price > 0, price), "mileage": number(F.col("mileage").cast("string")), "vin": F.when(~F.col("vin").rlike(r"^0{8,}\d?$"), F.col("vin")), "is_active": ~sold, "listing_type": F.lit("classified"), "listing_status": F.when(sold, "sold").otherwise("live"), "price_type": F.lit("asking")}
    return adapted(raw, "dupont", gates, record, "listing")


def barrett_jackson(raw: DataFrame) -> DataFrame:
    """API records: item_id, title, price_decimal, run_datetime, is_sold, is_canceled, event_slug, slug."""
    price, at = F.col("price_decimal").try_cast("double"), timestamp("run_datetime")
    gates = [(~F.coalesce(F.col("is_canceled"), F.lit(False)), "canceled lot"), (F.col("is_sold"), "not sold (preview or unsold lot)"), (text("title") != "", "no title"), (price > 1, "missing or sentinel price"), (at.isNotNull(), "no sale date in API record"), (F.coalesce(F.col("item_id").cast("string"), F.lit("")) != "", "no stable lot id"), (F.col("event_slug").isNotNull() & F.col("slug").isNotNull(), "missing event or lot slug")]
    url = F.concat(F.lit("https://www.barrett-jackson.com/"), F.col("event_slug"), F.lit("/docket/vehicle/"), F.col("slug"), F.lit("-"), F.col("item_id"))
    return adapted(raw, "bj", gates, {"lot": F.col("item_id"), "url": url, "title": text("title"), "sold_at": at, "price": price, "status": F.lit("sold")})


def barrett_jackson_cards(raw: DataFrame) -> DataFrame:
    """Docket cards: href, cardText, status, and sold_at."""
    href, card = F.coalesce("href", F.lit("")), F.concat_ws(" ", "status", "cardText")
    shape = r"/docket/(vehicle|automobilia)/([^/?#]+?)-(\d+)(?:[?#].*)?$"
    title, price = slug_title(F.regexp_extract(href, shape, 2)), number(first(card, r"\$\s?([\d][\d,]*(?:\.\d+)?)"))
    status = F.when(card.rlike(r"(?i)\bSOLD\s+AFTER\b"), "sold_after").when(card.rlike(r"(?i)\b(?:NOT\s+SOLD|RESERVE\s+NOT\s+MET|BID\s+GOES\s+ON|BID\s+TO)\b"), "reserve_not_met").when(card.rlike(r"(?i)\bSOLD\b"), "sold")
    gates = [(href.rlike(shape), "unrecognised lot URL"), (F.regexp_extract(href, shape, 1) == "vehicle", "automobilia docket path"), (title != "", "no title derivable from slug"), (~title.rlike(OBJECTS), "automobilia/memorabilia"), (~status.eqNullSafe("reserve_not_met"), "not sold / reserve not met"), (status.isNotNull(), "missing explicit sold status"), (price > 0, "no price on card"), (price > 1, "sentinel price ($1 = undisclosed/charity)"), (F.col("sold_at").isNotNull(), NO_DATE)]
    return adapted(raw, "bj", gates, {"lot": F.regexp_extract(href, shape, 3), "url": href, "title": title, "sold_at": timestamp("sold_at"), "price": price, "status": status})


def hagerty(raw: DataFrame) -> DataFrame:
    """Pages: url, title, text, and as_of. The words of the outcome decide: sold or sold after, bid to, withdrawn, reserve not met, ended, live."""
    # in steps, each used by the next more than once, so that no expression is spelled out over and over
    said = {n: first(F.col("body"), rf"(?i)\b{w}\s*[:\-]?\s*([^\n|]{{0,90}})") for n, w in (("sold_", r"Sold\s+(?:for|after)"), ("bid_", r"Bid\s+to"), ("gone_", r"Withdrawn(?:\s+on)?"), ("ending_", "Ending"))}
    raw = raw.withColumn("body", F.coalesce("text", F.lit(""))).withColumns(said)
    body, sold, bid, gone = (F.col(c) for c in ("body", "sold_", "bid_", "gone_"))
    money = r"([€£$¥])\s*([\d][\d,]*(?:\.\d+)?)"
    raw = raw.withColumn("near_", F.coalesce(sold, bid, first(body, r"(?i)(?:current bid|high bid|asking(?: price)?|price)\s*[:\-]?\s*([^\n|]{0,80})"), body))
    raw = raw.withColumns({"amount_": number(first(F.col("near_"), money, 2)), "currency_": F.coalesce(currency_of(first(F.col("near_"), money, 1)), F.lit("USD")), "ends_": timestamp("ending_"), "at_": F.coalesce(timestamp(F.coalesce(sold, bid, gone)), timestamp("body"))})
    ends, amount, currency, at = (F.col(c) for c in ("ends_", "amount_", "currency_", "at_"))
    live = body.rlike(r"(?i)\b(?:place bid|current bid|make an offer|for sale|available)\b")
    raw = raw.withColumn("status_", F.when(sold.isNotNull(), F.when(body.rlike(r"(?i)\bsold\s+after\b"), "sold_after").otherwise("sold")).when(bid.isNotNull(), "bid_to").when(gone.isNotNull(), "withdrawn").when(body.rlike(r"(?i)\breserve\s+not\s+met\b"), "reserve_not_met").when(ends <= F.col("as_of"), "ended").when(ends.isNotNull() | live, "live").otherwise("unknown"))
    status = F.col("status_")
    is_sale = status.isin("sold", "sold_after")
    path = F.regexp_replace(F.coalesce("url", F.lit("")), r"[?#].*$|/+$", "")
    lot = F.lower(F.coalesce(first(path, r"(?i)([0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12})"), F.left(F.substring_index(path, "/", -1), F.lit(160))))
    auction = F.coalesce(F.col("url"), F.lit("")).contains("/auction/") | body.rlike(r"(?i)\b(?:auction|bid|ending)\b")
    gates = [(F.coalesce(lot, F.lit("")) != "", "no stable lot id"), (text("title") != "", "no title"), (~is_sale | (amount > 0), "auction outcome has no parseable price"), (~is_sale | at.isNotNull(), "auction outcome has no parseable date")]
    high = status.isin("bid_to", "reserve_not_met")
    record = {"lot": lot, "url": F.col("url"), "title": text("title"), "sold_at": F.when(is_sale, at), "price": amount, "currency": currency, "status": F.when(is_sale, status), "listing_type": F.when(~is_sale, F.when(auction, "auction").otherwise("classified")), "listing_status": F.when(~is_sale, status), "price_type": F.when(~is_sale, F.when(high, "high_bid").when(auction, "current_bid").otherwise("asking")), "current_bid": F.when(high | (status == "live"), amount), "ends_at": F.when(status == "live", ends), "closed_at": F.when(~status.isin("live", "unknown"), F.coalesce(F.when(status == "ended", ends), at)), "is_active": status == "live"}
    return adapted(raw, "hagerty", gates, record, F.when(is_sale, "sale").otherwise("listing"))


def classic(raw: DataFrame) -> DataFrame:
    """Aggregator lots: url, title, outcome, price, date, mileage, vin_raw, upstream_url. Leads only: a price here is hearsay."""
    host = F.try_parse_url("url", F.lit("HOST"))
    lot = first(F.col("url"), r"(?i)/veh/([^/?#]+)")
    said = F.lower(text("outcome"))
    outcome = F.when(said.rlike("not sold|no sale|bid to|reserve"), "reserve_not_met").when(said.rlike("sold"), "sold").when(said.rlike("for sale|active"), "live").otherwise("unknown")
    hearsay = F.when(~text("price").rlike("(?i)ask for price|contact seller|price upon request|n/a"), number(first(text("price"), r"\$\s*([\d,]+(?:\.\d+)?)")))
    extra = F.to_json(F.struct(outcome.alias("outcome"), hearsay.alias("reported_price_usd"), F.col("upstream_url")))
    gates = [(host.rlike(r"(?i)^(www\.)?classic\.com$"), "not a page of the aggregator"), (lot.isNotNull(), "no vehicle id"), (text("title") != "", "no title")]
    return adapted(raw, "classic", gates, {"lot": lot, "url": F.substring_index("url", "?", 1), "title": text("title"), "sold_at": timestamp("date"), "mileage": miles("mileage"), "vin": E.normal_vin(F.col("vin_raw")), "currency": F.lit(None), "price_usd": F.lit(None), "extra": extra}, "lead")


ADAPTERS = {"bat": bat, "cab": cab, "rms": rms, "mecum": mecum, "bon": bonhams, "good": gooding, "broadarrow": broadarrow, "sms": sms, "dupont": dupont, "bj": barrett_jackson, "bj_cards": barrett_jackson_cards, "hagerty": hagerty, "classic": classic}
