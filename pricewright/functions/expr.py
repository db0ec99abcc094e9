"""Column builders for the valuation's formulas: no Python per row, no wall clock."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY, YEAR_DAYS = 86_400.0, 365.25


def half_up(x: Column, places: int = 0) -> Column:
    """Round half towards positive infinity (``round`` goes away from zero)."""
    scale = 10.0**places
    out = F.floor(x * scale + 0.5)
    return out if not places else out / scale


def clamp(x: Column, low, high) -> Column:
    """``x`` within bounds; null stays null (greatest and least pass nulls over)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def at_least(x: Column, steps: Sequence[tuple], otherwise) -> Column:
    """Value of the first step (bound, value) whose bound ``x`` reaches."""
    return reduce(lambda rest, s: F.when(x >= s[0], s[1]).otherwise(rest), reversed(steps), F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise)


def at_most(x: Column, steps: Sequence[tuple], otherwise) -> Column:
    return reduce(lambda rest, s: F.when(x <= s[0], s[1]).otherwise(rest), reversed(steps), F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise)


def days_before(as_of: Column, at: Column) -> Column:
    """Fractional days from ``at`` to ``as_of``."""
    return (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / (DAY * 1e6)


def years_before(as_of: Column, at: Column) -> Column:
    return days_before(as_of, at) / YEAR_DAYS


def mileage_adjusted(value: Column, miles: Column, avg_miles: Column, desirability: Column, age: Column) -> Column:
    """``value`` at ``miles``: low mileage earns a premium that grows with desirability and age, high mileage costs."""
    gap = (miles - avg_miles) / F.greatest(avg_miles, F.lit(5000.0))
    off = F.abs(gap)
    care = F.when(desirability.isNull(), 1.0).otherwise(at_least(desirability, [(9, 1.5), (7, 1.2), (5, 1.0)], 0.7))
    old = F.when(age.isNull() | (gap >= 0), 1.0).otherwise(at_least(age, [(30, 1.5), (20, 1.3), (10, 1.1)], 1.0))
    delivery = at_most(miles, [(500, 1.25), (1000, 1.1)], 1.0)
    premium = F.when(off < 0.15, 0.05 * off * care).when(off < 0.4, 0.0075 + (off - 0.15) * 0.15 * care).when(off < 0.7, (0.045 + (off - 0.4) * 0.3 * care) * old).otherwise((0.135 + (off - 0.7) * 0.6 * care) * old * delivery)
    soft = at_least(care, [(1.5, 0.8), (1.2, 0.9)], 1.0)
    cost = F.when(off < 0.25, 0.02 * off * soft).when(off < 0.75, 0.005 + (off - 0.25) * 0.05 * soft).when(off < 2, 0.03 + (off - 0.75) * 0.08).otherwise(0.13 + (off - 2) * 0.1)
    least = -at_least(desirability, [(9, 0.30), (7, 0.25)], 0.30)
    most = at_least(desirability, [(9, 0.45), (7, 0.30), (5, 0.20)], 0.15)
    change = F.when(gap < 0, premium).otherwise(-cost)
    return half_up(value * (1 + F.greatest(least, F.least(most, change))))


#: Annual depreciation at a value, straight lines between.
DEPRECIATION = ((25_000, 0.100), (75_000, 0.000), (150_000, 0.075), (350_000, 0.045), (500_000, 0.090))


def depreciation(value: Column) -> Column:
    out = F.lit(DEPRECIATION[-1][1])
    for (x0, y0), (x1, y1) in reversed(list(zip(DEPRECIATION, DEPRECIATION[1:]))):
        out = F.when(value <= x1, y0 + (value - x0) / (x1 - x0) * (y1 - y0)).otherwise(out)
    return F.when(value.isNull(), 0.0).when(value <= DEPRECIATION[0][0], DEPRECIATION[0][1]).otherwise(out)


#: Makes of each market segment, and the value from which any make belongs to it.
SEGMENTS = (
    ("hypercar", ("Bugatti", "Pagani", "Koenigsegg"), 1_500_000),
    ("exotic", ("Ferrari", "Lamborghini", "McLaren", "Rolls-Royce", "Bentley", "Aston Martin", "Maserati"), 400_000),
    ("perf", ("Porsche", "Mercedes-Benz", "Mercedes-AMG", "BMW", "Audi", "Jaguar", "Land Rover", "Range Rover", "Lotus", "Alfa Romeo"), 90_000),
)


def segment(make: Column, value: Column) -> Column:
    out = F.lit("mainstream")
    for name, makes, above in reversed(SEGMENTS):
        out = F.when(make.isin(*makes) | (F.coalesce(value, F.lit(0.0)) > above), name).otherwise(out)
    return out


def confidence_score(n: Column, r2: Column, volatility: Column) -> Column:
    sample = at_least(n, [(20, 1.0), (12, 0.8), (8, 0.6), (5, 0.4), (3, 0.2)], 0.0)
    fit = clamp((r2 - 0.10) / 0.35, 0.0, 1.0)
    steady = at_most(volatility, [(0, 0.50), (0.18, 1.00), (0.28, 0.75), (0.40, 0.50), (0.55, 0.25)], 0.0)
    return 0.40 * sample + 0.35 * fit + 0.25 * steady


def confidence_level(score: Column, n: Column, volatility: Column) -> Column:
    """A high score needs twelve sales and steady prices; under four sales it is low."""
    return F.when(n < 4, "low").when((score >= 0.62) & (n >= 12) & (volatility <= 0.40), "high").when(score >= 0.36, "moderate").otherwise("low")


def signal(n: Column, span_days: Column, annual: Column, recent: Column) -> Column:
    usable = (n >= 3) & (span_days >= 180) & annual.isNotNull() & (F.abs(annual) <= 2.0)
    falling = F.when(recent > 0.02, "bottomed").when(recent > -0.02, "approaching").otherwise("depreciating")
    return F.when(~F.coalesce(usable, F.lit(False)), "insufficient").when(F.abs(annual) < 0.03, "stable").when(annual >= 0.03, "appreciating").otherwise(falling)


#: Label and text for a signal; (signal, condition's name, label, text), the first that holds.
TIMING = (
    ("bottomed", "sure", "Buy Now", "Prices have bottomed — strong entry point."),
    ("bottomed", "", "Likely Entry", "This call rests on thinner data — verify condition and spec, and negotiate."),
    ("approaching", "", "Wait for Better Entry", "Still declining, but the fall is slowing."),
    ("depreciating", "", "Wait", "Actively depreciating — waiting is cheaper than buying the decline."),
    ("appreciating", "fast", "Buy Now (Rising Fast)", "Strong appreciation. Delaying will cost more."),
    ("appreciating", "", "Buy Soon", "Prices rising. Good for long-term hold."),
    ("stable", "", "Fair Entry", "Stable prices. Negotiate on spec and condition."),
    ("insufficient", "", "Watch", "Not enough sold data for a timing call yet."),
)


def timing(sig: Column, score: Column, annual: Column, text: bool = False) -> Column:
    when = {"sure": F.coalesce(score, F.lit(0.0)) > 0.6, "fast": F.coalesce(annual, F.lit(0.0)) > 0.08, "": F.lit(True)}
    out = F.lit("Mixed signals — check back as new sales land." if text else "Watch Closely")
    for name, condition, label, copy in reversed(TIMING):
        out = F.when((sig == name) & when[condition], copy if text else label).otherwise(out)
    return out


def forecast_rate(trend: Column, desirability: Column, age: Column, msrp_ratio: Column, sig: Column, n: Column, r2: Column) -> tuple[Column, Column]:
    """Annual rate blended from trend, desirability, age, list price and signal, and the factor that damps it each year."""
    above = lambda steps, otherwise: reduce(lambda rest, s: F.when(msrp_ratio > s[0], s[1]).otherwise(rest), reversed(steps), F.lit(otherwise))
    by_price = F.when(msrp_ratio.isNull(), 0.0).otherwise(above([(2, 0.03), (1.2, 0.02), (0.8, -0.01), (0.5, -0.02)], 0.01))
    by_age = at_most(age, [(2, -0.1), (5, -0.06), (10, -0.02), (20, 0.01), (35, 0.03)], 0.04)
    floor = F.when(age > 6, at_least(desirability, [(8, 0.02), (6, -0.02)], -1.0)).otherwise(at_least(desirability, [(8, -0.03), (6, -0.04)], -1.0))
    by_signal = F.when(sig == "appreciating", 0.02).when(sig == "bottomed", 0.03).when(sig == "approaching", 0.01).when(sig == "depreciating", -0.02).otherwise(0.0)
    parts = [trend, (desirability - 5) * 0.01, F.greatest(by_age, floor), by_price, by_signal]
    regimes = [
        (sig.isin("depreciating", "appreciating"), (0.65, 0.13, 0.12, 0.06, 0.04)),
        (sig == "approaching", (0.55, 0.15, 0.13, 0.10, 0.07)),
        ((n >= 25) & (r2 > 0.5), (0.50, 0.20, 0.10, 0.10, 0.10)),
        (n >= 10, (0.35, 0.25, 0.15, 0.15, 0.10)),
        (F.lit(True), (0.20, 0.30, 0.25, 0.15, 0.10)),
    ]
    blend = lambda w: sum((wi * p for wi, p in zip(w[1:], parts[1:])), w[0] * parts[0])
    rate = reduce(lambda rest, r: F.when(r[0], blend(r[1])).otherwise(rest), reversed(regimes), F.lit(None).cast("double"))
    rate = F.greatest(at_least(desirability, [(8, -0.06), (6, -0.10)], -0.15), F.least(at_least(desirability, [(9, 0.14), (7, 0.12), (5, 0.10)], 0.08), rate))
    brake = F.when(sig == "approaching", 0.34).otherwise(at_most(age, [(5, 0.65)], 0.5)) * trend
    rate = F.when(sig.isin("depreciating", "approaching") & (trend <= -0.03), F.least(rate, brake)).otherwise(rate)
    damp = F.when(rate < -0.05, at_least(F.abs(rate), [(0.12, 0.62), (0.08, 0.70)], 0.78)).otherwise(at_least(desirability, [(9, 0.94), (7, 0.90), (5, 0.85)], 0.82))
    return rate, damp


def projected(value: Column, rate: Column, damp: Column, years: int, floor: Column) -> Column:
    """``value`` after so many years at a rate that fades each year, never below ``floor``."""
    start = F.struct(value.cast("double").alias("v"), rate.alias("r"))
    return half_up(F.aggregate(F.sequence(F.lit(1), F.lit(years)), start, lambda s, _: F.struct(F.greatest(floor.cast("double"), s["v"] * (1 + s["r"])).alias("v"), (s["r"] * damp).alias("r")), lambda s: s["v"]))


def decline(value: Column, rate: Column, damp: Column, floor: Column, years: int = 5) -> Column:
    """struct(bottom_value, bottom_years, status, recovery): quarter by quarter until the fall flattens or meets the floor."""
    v0 = value.cast("double")
    low = floor.cast("double")
    start = F.struct(v0.alias("v"), (rate / 4).alias("r"), F.lit(0).alias("q"), F.lit("did_not_converge").alias("status"))

    def quarter(s: Column, q: Column) -> Column:
        after = F.greatest(low, s["v"] * (1 + s["r"]))
        done = s["status"] != "did_not_converge"
        ends = F.when(after <= low, "floor_reached").when(F.abs(after - s["v"]) / s["v"] < 0.005, "flattened").otherwise("did_not_converge")
        return F.when(done, s).otherwise(F.struct(after.alias("v"), (s["r"] * F.pow(damp, 0.25)).alias("r"), q.alias("q"), ends.alias("status")))

    def result(s: Column) -> Column:
        at = F.when(s["status"] == "did_not_converge", F.lit(float(years))).otherwise(half_up(s["q"] / 4, 1))
        back = F.least(s["v"] + 0.6 * (v0 - s["v"]), s["v"] * F.pow(F.lit(1.015), F.greatest(F.lit(0.0), years - at)))
        return F.struct(half_up(s["v"]).alias("bottom_value"), at.alias("bottom_years"), s["status"].alias("status"), F.when(s["status"] != "did_not_converge", half_up(back)).alias("recovery"))

    falling = F.aggregate(F.sequence(F.lit(1), F.lit(4 * years)), start, quarter, result)
    flat = F.struct(F.lit(None).cast("bigint").alias("bottom_value"), F.lit(None).cast("double").alias("bottom_years"), F.lit("not_declining").alias("status"), F.lit(None).cast("bigint").alias("recovery"))
    return F.when(rate >= 0, flat).otherwise(falling)


#: Critical values of Student's t by degrees of freedom (the first that is not below), then the limit.
T_VALUES = ((1, 6.31), (2, 2.92), (3, 2.35), (4, 2.13), (5, 2.02), (6, 1.94), (7, 1.89), (8, 1.86), (9, 1.83), (10, 1.81), (15, 1.75), (20, 1.72), (30, 1.70), (60, 1.67))


def t_critical(df: Column) -> Column:
    return at_most(df, T_VALUES, 1.65)


def bound_return(slope: Column, se: Column, df: Column, side: int) -> Column:
    """Annual return at the end of the slope's interval: the worse for side 1, the better for -1."""
    return F.expm1(-(slope + side * t_critical(df) * se))


def shrunk(estimate: Column, mean: Column, df: Column, strength: float = 25.0) -> Column:
    held = F.greatest(df.cast("double"), F.lit(0.0))
    return mean + (estimate - mean) * (held / (held + strength))


def liquidity(sales_24mo: Column, listings: Column) -> tuple[Column, Column, Column]:
    """Verdict, tier and months of supply; under four sales the market is thin and has neither."""
    supply = listings / F.greatest(F.lit(0.5), sales_24mo / 2) * 12
    thin = sales_24mo < 4
    verdict = F.when(thin, "THIN MARKET").when(listings <= 1, "TIGHT SUPPLY").when(supply < 6, "SELLER'S MARKET").when(supply <= 18, "BALANCED").otherwise("BUYER'S MARKET")
    tier = F.when(thin, None).when((listings <= 1) | (supply < 6), "high").when(supply <= 18, "moderate").otherwise("low")
    return verdict, tier, F.when(~thin, supply)


def deal_score_98(ask: Column, fair: Column) -> Column:
    return clamp(half_up(55 - 250 * (ask - fair) / fair), 5, 98)


def plausible_mileage(miles: Column, year: Column, as_of: Column) -> Column:
    """A zero odometer of an item over three years old is a placeholder."""
    return F.when((miles != 0) | (F.year(as_of) - year <= 3), miles)


# text


def canonical_url(url: Column) -> Column:
    """Lower case, without query, fragment and trailing slashes; null if nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*", 0), "/+$", "")), F.lit(""))


#: Words found in place of an identification number.
NO_VIN = ("NUMBER", "NUMBERS", "NUMER", "NO", "N", "VIN", "CHASSIS", "SERIAL", "NONE", "NA", "N/A", "UNKNOWN", "TBD", "UPGRADES", "PENDING", "ONFILE", "AVAILABLE", "REQUEST")
VIN_YEARS = "ABCDEFGHJKLMNPRSTVWXY123456789"


def normal_vin(raw: Column) -> Column:
    """Upper-case letters and digits, 5 to 17 of them with a digit, not all the same and no placeholder; else null."""
    v = F.regexp_replace(F.upper(raw), "[^A-Z0-9]", "")
    return F.when(F.length(v).between(5, 17) & ~v.isin(*NO_VIN) & v.rlike("[0-9]") & ~v.rlike(r"^(.)\1+$"), v)


def valid_vin(raw: Column) -> Column:
    v = normal_vin(raw)
    return F.coalesce((F.length(v) >= 11) & ((F.length(v) != 17) | ~v.rlike("[IOQ]")), F.lit(False))


def vin_years(raw: Column) -> Column:
    """The two model years that a 17-character number can mean, or null."""
    v = normal_vin(raw)
    at = F.instr(F.lit(VIN_YEARS), F.substring(v, 10, 1))
    return F.when((F.length(v) == 17) & (at > 0), F.array(F.lit(1979) + at, F.lit(2009) + at))


def vin_year_plausible(raw: Column, year: Column) -> Column:
    return F.coalesce(F.exists(vin_years(raw), lambda y: F.abs(y - year) <= 1), F.lit(True))


def trigrams(text: Column) -> Column:
    """Distinct runs of three characters of the text in lower case, white space single; none of a shorter one."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))

    def of(c: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(c) - 3), lambda i: F.concat(F.get(c, i), F.get(c, i + 1), F.get(c, i + 2)))
        return F.when(F.size(c) >= 3, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))

    # the characters are named once, so that the text is not cleaned again for each place
    return F.element_at(F.transform(F.array(F.split(clean, "")), of), 1)


def set_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays without repeats; 0 if either is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


#: Trust rank of a source, lower is better.
SOURCE_TRUST = {"bat": 1, "cab": 1, "rms": 1, "sms": 1, "good": 1, "bon": 1, "bj": 1, "mecum": 1, "broadarrow": 1, "pcar": 1, "collectingcars": 1, "hagerty": 2, "dupont": 2, "carscom": 3, "classic": 9}
OTHER_TRUST, DUPLICATE, WINDOW_DAYS = 5, 0.75, 7


def source_trust(source: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in SOURCE_TRUST.items() for x in pair]), source), F.lit(OTHER_TRUST))


def duplicate_score(a: str, b: str) -> Column:
    """How far two sales, columns prefixed ``a`` and ``b``, are one: 1 by url or number, else by price, date, mileage and title."""
    x, y = (lambda c: F.col(a + c)), (lambda c: F.col(b + c))
    return _score(x, y, x("mileage"), set_similarity(trigrams(x("title")), trigrams(y("title"))))


def duplicate_score_at_most(a: Column, b: Column) -> Column:
    """What ``duplicate_score`` of two sales, as structs, does not exceed in either order: that of equal titles, whatever theirs are."""
    return _score(lambda c: a[c], lambda c: b[c], F.greatest(a["mileage"], b["mileage"]), F.lit(1.0))


def is_duplicate(a: str, b: str) -> Column:
    """Whether ``duplicate_score`` reaches the threshold; titles are compared only if the rest does not tell."""
    x, y = (lambda c: F.col(a + c)), (lambda c: F.col(b + c))
    least, most = (_score(x, y, x("mileage"), F.lit(alike)) for alike in (0.0, 1.0))
    return F.when(least >= DUPLICATE, True).when(most >= DUPLICATE, duplicate_score(a, b) >= DUPLICATE).otherwise(False)


def _score(x, y, driven: Column, alike: Column) -> Column:
    apart = F.coalesce(F.abs(days_before(x("sold_at"), y("sold_at"))), F.lit(1e18))
    near = apart <= WINDOW_DAYS
    same_page = (canonical_url(x("url")) == canonical_url(y("url"))) & (x("source") == y("source")) & near
    top = F.greatest(x("price_usd"), y("price_usd"))
    gap = F.when(x("price_usd").isNotNull() & y("price_usd").isNotNull() & (top > 0), F.abs(x("price_usd") - y("price_usd")) / top)
    price = F.when(gap < 0.005, 0.45).when(gap < 0.02, 0.20).when(gap <= 0.13, 0.30).otherwise(0.0)
    date = F.when(apart <= 2, 0.25).when(near, 0.10).otherwise(0.0)
    miles = F.when(F.abs(x("mileage") - y("mileage")) <= F.greatest(F.lit(100.0), 0.01 * driven), 0.20).otherwise(0.0)
    soft = price + date + miles + 0.10 * alike
    both = x("vin_normal").isNotNull() & y("vin_normal").isNotNull()
    return F.when(same_page, 1.0).when(both, F.when((x("vin_normal") == y("vin_normal")) & near, 1.0).otherwise(0.0)).otherwise(soft)


def year_bucket(year: Column) -> Column:
    return F.when(year < 1960, "pre1960").when(year < 1970, "1960s").when(year < 1980, "1970s").when(year < 1990, "1980s").when(year < 2000, "1990s").when(year < 2010, "2000s").otherwise("2010plus")


# windows


def within(at: Column, first: Column, last: Column) -> Column:
    """Whether a time is from the first day's begin to the last day's end; false if it is none."""
    return F.coalesce((at >= F.to_date(first)) & (at < F.date_add(F.to_date(last), 1)), F.lit(False))


def year_within(text: Column, first: Column, last: Column) -> Column:
    """Whether the first year of the 20th or 21st century that a text names lies in the years of the window."""
    year = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?:19|20)\d{2}", 0).try_cast("int")
    return F.coalesce(year.between(F.year(first), F.year(last)), F.lit(False))


def recent_window(first: Column, last: Column, as_of: Column, days: int) -> tuple[Column, Column]:
    """The configured window cut to the last ``days`` before ``as_of``, and never beyond it."""
    return F.greatest(first.cast("timestamp"), as_of - F.make_dt_interval(F.lit(max(1, days)))), F.least(last.cast("timestamp"), as_of)


def aged_at_most(at: Column, as_of: Column, days: float) -> Column:
    """Whether a time is past and no more than ``days`` ago."""
    age = days_before(as_of, at)
    return F.coalesce((age >= 0) & (age <= days), F.lit(False))


# JSON


def json_or_null(items: Column) -> Column:
    """A list as JSON, null for none and for an empty one."""
    return F.when(F.size(items) > 0, F.to_json(items))


def json_list(text: Column, kind: str = "string") -> Column:
    """A list stored as JSON; null and what cannot be read are an empty list."""
    return F.coalesce(F.from_json(text, f"array<{kind}>"), F.array().cast(f"array<{kind}>"))


def lacks(text: Column, path: str) -> Column:
    """Whether a JSON text has nothing at the path."""
    return F.get_json_object(text, path).isNull()


def event_end(json_ld: Column) -> Column:
    """The first date of a page's JSON-LD, one event or several: an event's end, else its start."""
    event = "struct<endDate:string,startDate:string>"
    nodes = F.when(F.trim(json_ld).startswith("["), F.from_json(json_ld, f"array<{event}>")).otherwise(F.array(F.from_json(json_ld, event)))
    said = F.transform(nodes, lambda n: F.coalesce(F.nullif(n["endDate"], F.lit("")), n["startDate"]))
    return F.regexp_extract(F.get(F.filter(said, lambda x: x.rlike(r"\d{4}-\d{2}-\d{2}")), 0), r"\d{4}-\d{2}-\d{2}", 0).try_cast("date")
