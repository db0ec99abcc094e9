"""Queries of the market's read side: browse, deals, search, groups, portfolios, currency."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expr as E
from ..operators import fx
from . import market as M
from . import market_sql as R
from .valuation_queries import own_values, r6

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


#: Year buckets and price bands of the browse page (bounds belong to both bands they part).
YEARS = {"pre70": (None, 1969), "70s": (1970, 1979), "80s": (1980, 1989), "90s": (1990, 1999), "00s": (2000, 2009), "10s": (2010, 2019), "20s": (2020, None)}
PRICES = {"under50k": (None, 50_000), "50to100k": (50_000, 100_000), "100to250k": (100_000, 250_000), "250kplus": (250_000, None)}
MAKE_FAMILIES = {"Mercedes": ("Mercedes-Benz", "Mercedes-AMG", "Mercedes-Maybach")}
SORTS = {"popular": ("sales_count", False), "price-low": ("current_value", True), "price-high": ("current_value", False), "year-new": ("year", False), "year-old": ("year", True)}


def browse(values: DataFrame, items: DataFrame, make=None, year=None, price=None, q=None, for_sale=False, sort="popular", limit=50, page=1) -> DataFrame:
    """A page of items with their values; ties in the sort go by item_id."""
    v = items.join(values.select("item_id", "current_value", "signal", "confidence", "segment", "sales_count", "n_listings"), "item_id", "left").withColumn("n_listings", F.coalesce("n_listings", F.lit(0)))
    v = v.filter("current_value is null or current_value >= 2000")
    if make:
        v = v.filter(F.lower("make").isin(*[m.lower() for m in MAKE_FAMILIES.get(make, (make,))]))
    if year in YEARS:
        low, high = YEARS[year]
        v = v.filter((F.col("year") >= (low or -(1 << 30))) & (F.col("year") <= (high or 1 << 30)))
    if price in PRICES:
        low, high = PRICES[price]
        # the outer bands leave their bound out
        v = v.filter(F.col("current_value") < high if low is None else F.col("current_value") > low if high is None else F.col("current_value").between(low, high))
    if q:
        v = v.filter(F.contains(F.lower("make"), F.lit(q.lower())) | F.contains(F.lower("model"), F.lit(q.lower())))
    if for_sale:
        v = v.filter("n_listings > 0")
    column, up = SORTS.get(sort, SORTS["popular"])
    order = F.col(column).asc_nulls_first() if up else F.col(column).desc_nulls_last()
    limit = min(limit, 200)
    return v.orderBy(order, "item_id").offset((max(page, 1) - 1) * limit).limit(limit)


@query(R.own(R.GROUPED) + """
select item_id, i.year::int as year, i.make, v4.current_value, v4.sales_count, v4.signal from item i left join v4 using (item_id)
where (v4.current_value is null or v4.current_value >= 2000) and lower(i.make) = 'brand#7' and i.year between 1970 and 1999 and coalesce(v4.n_listings, 0) > 0
order by v4.current_value desc nulls last, item_id limit 20 offset 20""")
def browse_page(spark: SparkSession, d: str) -> DataFrame:
    items = M.items(spark, d).filter("year between 1970 and 1999")
    return browse(own_values(spark, d), items, make="Brand#7", for_sale=True, sort="price-high", limit=20, page=2).select("item_id", "year", "make", "current_value", "sales_count", "signal")


@query(f"with {R.TABLES} select case when year < 1970 then 'pre70' when year < 1980 then '70s' when year < 1990 then '80s' when year < 2000 then '90s' when year < 2010 then '00s' when year < 2020 then '10s' else '20s' end as bucket, count(*) as n from item group by 1")
def year_bucket_counts(spark: SparkSession, d: str) -> DataFrame:
    bucket = F.lit(None).cast("string")
    for name, (low, high) in YEARS.items():
        bucket = F.when((F.col("year") >= (low or -(1 << 30))) & (F.col("year") <= (high or 1 << 30)), name).otherwise(bucket)
    return M.items(spark, d).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query(R.own(R.GROUPED) + """
select 'under50k' as band, count(*) as n from v4 where current_value < 50000 union all select '50to100k', count(*) from v4 where current_value between 50000 and 100000
union all select '100to250k', count(*) from v4 where current_value between 100000 and 250000 union all select '250kplus', count(*) from v4 where current_value > 250000""")
def price_band_counts(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("current_value")
    inside = {n: v < h if lo is None else v > lo if h is None else v.between(lo, h) for n, (lo, h) in PRICES.items()}
    row = own_values(spark, d).agg(*[F.count_if(c).alias(n) for n, c in inside.items()])
    return row.unpivot([], list(inside), "band", "n")


@query("select l_partkey as item_id, arg_max(l_linestatus, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) as linestatus, max(l_shipdate) as sold_at from lineitem group by l_partkey")
def latest_attribute_per_car(spark: SparkSession, d: str) -> DataFrame:
    newest = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return M.table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("item_id")).agg(F.max_by("l_linestatus", newest).alias("linestatus"), F.max("l_shipdate").alias("sold_at"))


@query(f"with {R.TABLES} select item_id from item where item_id in (select item_id from sale where mileage >= 49000) or item_id in (select item_id from listing where ask < 2000)")
def semi_cars_with_activity(spark: SparkSession, d: str) -> DataFrame:
    """Items with a sale of high mileage or a low ask: one semi-join with the union of both, not two existence joins."""
    active = M.sales(spark, d).filter("mileage >= 49000").select("item_id").union(M.listings(spark, d).filter("ask < 2000").select("item_id")).distinct()
    return M.items(spark, d).join(active, "item_id", "left_semi").select("item_id")


@query(f"with {R.TABLES} select item_id from item where not exists (select 1 from sale where sale.item_id = item.item_id and sold_at >= timestamp '2001-06-01' and not unsold)")
def anti_parts_without_sales(spark: SparkSession, d: str) -> DataFrame:
    recent = M.sales(spark, d).filter("sold_at >= timestamp '2001-06-01' and not reserve_not_met").select("item_id")
    return M.items(spark, d).join(recent, "item_id", "left_anti").select("item_id")


def judged_asks(spark: SparkSession, d: str) -> DataFrame:
    """Asks under the item's value, with a verdict from the least price it was ever sold for."""
    values = own_values(spark, d).filter("current_value > 0").select("item_id", "current_value", "confidence", "year")
    sold = M.sales(spark, d).filter("status = 'sold'").groupBy("item_id").agg(F.min("price").alias("least_sold"))
    c = M.listings(spark, d).filter("ask > 0").join(values, "item_id").filter("ask < current_value").join(sold, "item_id", "left")
    c = c.withColumn("discount", (F.col("current_value") - F.col("ask")) / F.col("current_value"))
    reason = F.when(F.col("least_sold").isNull(), "no observed sales to sanity-check against").when(F.col("ask") < F.col("least_sold"), "below the cheapest verified sale").otherwise("within the observed sale range and under market")
    return c.withColumns({"reason": reason, "is_deal": F.coalesce(F.col("ask") >= F.col("least_sold"), F.lit(False)), "score": F.col("discount") * F.coalesce("confidence", F.lit(0.0)), "miles": E.plausible_mileage(F.col("mileage"), F.col("year"), M.as_of())})


_DEALS = R.own(R.GROUPED) + """
, sold as (select item_id, min(price) as least_sold from sale where not unsold group by item_id),
c as (select l.*, v4.current_value, v4.confidence, (v4.current_value - ask) / v4.current_value as discount, least_sold from listing l join v4 using (item_id) left join sold using (item_id) where ask > 0 and v4.current_value > 0 and ask < v4.current_value)
"""


@query(_DEALS + " select item_id, lot, line, ask, mileage as miles, current_value, round(discount, 6) as discount, round(discount * confidence, 6) as score from c where ask >= least_sold order by discount * confidence desc, item_id, lot, line, ask limit 40")
def deal_radar(spark: SparkSession, d: str) -> DataFrame:
    deals = judged_asks(spark, d).filter("is_deal").orderBy(F.desc("score"), "item_id", "lot", "line", "ask").limit(40)
    return deals.select("item_id", "lot", "line", "ask", "miles", "current_value", *r6("discount", "score"))


@query(_DEALS + " select case when least_sold is null then 'no observed sales to sanity-check against' when ask < least_sold then 'below the cheapest verified sale' else 'within the observed sale range and under market' end as reason, count(*) as n from c group by 1")
def deal_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return judged_asks(spark, d).groupBy("reason").agg(F.count("*").alias("n"))


_FAIR = R.adjusted("v4.current_value", "l.mileage", "v4.avg_mileage", "v4.desirability", "v4.age")


@query(R.own(R.GROUPED) + f", f as (select l.item_id, lot, line, ask, {_FAIR} as fair from listing l join v4 using (item_id)) select item_id, lot, line, ask, fair, greatest(5, least(98, floor(55 - 250 * (ask - fair) / fair + 0.5)::bigint)) as score from f")
def deal_score_0_98(spark: SparkSession, d: str) -> DataFrame:
    v = own_values(spark, d).select("item_id", "current_value", "avg_mileage", "desirability", "age")
    l = M.listings(spark, d).join(v, "item_id")
    fair = E.mileage_adjusted(F.col("current_value"), F.col("mileage"), F.col("avg_mileage"), F.col("desirability"), F.col("age"))
    return l.withColumn("fair", fair).select("item_id", "lot", "line", "ask", "fair", E.deal_score_98(F.col("ask"), F.col("fair")).alias("score"))


def grouped_models(values: DataFrame, items: DataFrame, min_sales: int = 1) -> DataFrame:
    """One row for each make and model line: years, sales, value of its most sold item, prevailing signal and its share."""
    v = items.join(values.select("item_id", "signal", "current_value", "sales_count", "timing"), "item_id", "left").withColumn("sold", F.coalesce("sales_count", F.lit(0)))
    key = ["make", "model_key"]
    votes = v.filter("signal is not null and signal <> 'insufficient'").groupBy(*key, "signal").agg(F.sum("sold").alias("w"))
    dominant = votes.groupBy(*key).agg(F.max_by("signal", F.struct("w", "signal")).alias("signal"), (F.max("w") / F.sum("w")).alias("agreement"))
    anchor = F.when(F.col("current_value").isNotNull(), F.struct("sold", (-F.col("item_id")).alias("i")))
    g = v.groupBy(*key).agg(F.sum("sold").alias("sales_count"), F.min("year").alias("year_start"), F.max("year").alias("year_end"), F.count("*").alias("model_years"), F.max_by("current_value", anchor).alias("current_value"), F.max_by("year", anchor).alias("anchor_year"), F.max_by("timing", anchor).alias("timing"), F.array_sort(F.collect_set("body")).alias("bodies"))
    return g.filter(F.col("sales_count") >= min_sales).join(dominant, key, "left").withColumn("signal", F.coalesce("signal", F.lit("insufficient"))).withColumn("agreement", F.round(F.coalesce("agreement", F.lit(0.0)), 2))


@query(R.own(R.GROUPED) + """
, v as (select i.item_id, i.make, i.model_key, i.year, v4.signal, v4.current_value, coalesce(v4.sales_count, 0) as sold, v4.timing from item i left join v4 using (item_id)),
votes as (select make, model_key, signal, sum(sold) as w from v where signal <> 'insufficient' group by all),
dom as (select make, model_key, arg_max(signal, (w, signal)) as signal, max(w) / sum(w) as agreement from votes group by all),
g as (select make, model_key, sum(sold)::bigint as sales_count, min(year)::int as year_start, max(year)::int as year_end, count(*) as model_years, arg_max(current_value, (sold, -item_id)) filter (current_value is not null) as current_value, arg_max(year, (sold, -item_id)) filter (current_value is not null)::int as anchor_year from v group by all)
select make, model_key, sales_count, year_start, year_end, model_years, current_value, anchor_year, coalesce(signal, 'insufficient') as signal, round(coalesce(agreement, 0.0), 2) as agreement from g left join dom using (make, model_key) where sales_count >= 1""")
def model_groups(spark: SparkSession, d: str) -> DataFrame:
    return grouped_models(own_values(spark, d), M.items(spark, d)).drop("bodies", "timing")


@query(R.own(R.GROUPED) + """
, asked as (select unnest([5, 3, 8, 1])::bigint as item_id, unnest([0, 1, 2, 3]) as pos),
s as (select item_id, array_to_string(list(round(price, 2)::varchar order by sold_at, lot, line, price), ' ') as prices, count(*) as n_sales from sale join asked using (item_id) group by item_id)
select pos::int as pos, item_id, current_value, signal, n_sales, len(string_split(prices, ' '))::bigint as n_listed from asked join v4 using (item_id) join s using (item_id)""")
def compare_cars(spark: SparkSession, d: str) -> DataFrame:
    """The first four items asked for, in that order, with their sales as arrays by date."""
    compared = compare(spark, d, [5, 3, 8, 1])
    return compared.select("pos", "item_id", "current_value", "signal", F.size("sales").cast("long").alias("n_sales"), F.size(F.filter("sales", lambda s: s["price"].isNotNull())).cast("long").alias("n_listed"))


def compare(spark: SparkSession, d: str, ids: list[int]) -> DataFrame:
    asked = spark.createDataFrame([(i, p) for p, i in enumerate(ids[:4])], "item_id long, pos int")
    sales = M.sales(spark, d).join(F.broadcast(asked), "item_id", "left_semi").groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("sold_at", "lot", "line", "price", "mileage"))).alias("sales"))
    return own_values(spark, d).join(F.broadcast(asked), "item_id").join(sales, "item_id").orderBy("pos")


def token_filter(q: str):
    """Condition of a search: four-digit tokens are years, any other must occur in make or model."""
    import re

    tokens = [t for t in re.split(r"[\W_]+", q.lower()) if t]
    condition = F.lit(len(q.strip()) >= 2 and bool(tokens))
    for t in tokens:
        is_year = len(t) == 4 and t.isdigit() and 1885 <= int(t) <= 2100
        condition = condition & (F.col("year") == int(t) if is_year else F.contains(F.lower("make"), F.lit(t)) | F.contains(F.lower("model"), F.lit(t)))
    return condition


@query(R.own(R.GROUPED) + " select item_id, i.year::int as year, i.make, i.model, v4.sales_count from item i join v4 using (item_id) where i.year = 1978 and (contains(lower(i.make), 'brand') or contains(lower(i.model), 'brand')) and (contains(lower(i.make), 'ring') or contains(lower(i.model), 'ring')) order by v4.sales_count desc, item_id limit 12")
def token_search(spark: SparkSession, d: str) -> DataFrame:
    found = M.items(spark, d).filter(token_filter("1978 Brand, ring!")).join(own_values(spark, d).select("item_id", "sales_count"), "item_id")
    return found.orderBy(F.desc("sales_count"), "item_id").limit(12).select("item_id", "year", "make", "model", "sales_count")


@query(f"with {R.TABLES} select (select count(*) from item) as items, (select count(*) from sale) as sales, (select count(distinct source) from sale) as sources, (select count(*) from listing) as listings, (select round(coalesce(sum(price), 0), 2) from sale) as volume")
def public_stats(spark: SparkSession, d: str) -> DataFrame:
    sold = M.sales(spark, d).agg(F.count("*").alias("sales"), F.countDistinct("source").alias("sources"), F.round(F.coalesce(F.sum("price_usd"), F.lit(0.0)), 2).alias("volume"))
    one = lambda df, n: F.broadcast(df.agg(F.count("*").alias(n)))
    return sold.join(one(M.items(spark, d), "items")).join(one(M.listings(spark, d), "listings"))


def holdings(spark: SparkSession, d: str) -> DataFrame:
    """What customers hold: one line of each of their filled orders, bought at its price, with a fee, priced at its mileage."""
    orders = M.table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("lot"), F.col("o_custkey").alias("user_id"))
    bought = M.sales(spark, d).groupBy("lot").agg(F.min(F.struct("line", "item_id", "price", "mileage")).alias("s")).select("lot", "s.item_id", F.col("s.price").alias("paid"), "s.mileage")
    v = own_values(spark, d).select("item_id", "current_value", "avg_mileage", "desirability", "age", "segment")
    worth = E.mileage_adjusted(F.col("current_value"), F.col("mileage"), F.col("avg_mileage"), F.col("desirability"), F.col("age"))
    held = orders.join(bought, "lot").join(v, "item_id", "left").withColumn("fees", F.lit(100.0)).withColumn("market_value", worth)
    cost = F.col("paid") + F.coalesce("fees", F.lit(0.0))
    return held.withColumns({"cost": cost, "gain": F.col("market_value") - cost}).withColumn("return_pct", F.when(F.col("cost") > 0, F.col("gain") / F.col("cost")))


_HELD = R.own(R.GROUPED) + f"""
, bought as (select lot, min({{'line': line, 'item_id': item_id, 'price': price, 'mileage': mileage}}) as s from sale group by lot),
held0 as (select o_custkey as user_id, lot, s.item_id as item_id, s.price as paid, s.mileage as mileage from orders join bought on lot = o_orderkey where o_orderstatus = 'F'),
held as (select h.*, v4.segment, paid + 100.0 as cost, {R.adjusted('v4.current_value', 'h.mileage', 'v4.avg_mileage', 'v4.desirability', 'v4.age')} as market_value from held0 h left join v4 using (item_id))
"""


@query(_HELD + " select user_id, count(*) as n, sum(market_value)::bigint as market_value, round(sum(cost), 2) as cost, round(sum(market_value - cost), 2) as gain, round(sum(market_value - cost) / sum(cost), 6) as return_pct from held group by user_id")
def portfolio_summary(spark: SparkSession, d: str) -> DataFrame:
    return holdings(spark, d).groupBy("user_id").agg(F.count("*").alias("n"), F.sum("market_value").alias("market_value"), F.round(F.sum("cost"), 2).alias("cost"), F.round(F.sum("gain"), 2).alias("gain"), F.round(F.sum("gain") / F.sum("cost"), 6).alias("return_pct"))


@query(_HELD + " select coalesce(segment, 'Unclassified') as segment, count(*) as n, sum(market_value)::bigint as market_value from held group by 1")
def portfolio_allocation(spark: SparkSession, d: str) -> DataFrame:
    return holdings(spark, d).groupBy(F.coalesce("segment", F.lit("Unclassified")).alias("segment")).agg(F.count("*").alias("n"), F.sum("market_value").alias("market_value"))


@query("""with s as (select o_custkey as user_id, o_orderdate::date as day, sum(o_totalprice) as value from orders group by all),
l as (select *, lag(value) over w as before, row_number() over (partition by user_id order by day desc) as r from s window w as (partition by user_id order by day))
select user_id, day, round(value, 2) as value, round(value - before, 2) as change, round((value - before) / nullif(before, 0), 6) as change_pct from l where r <= 180""")
def portfolio_day_change(spark: SparkSession, d: str) -> DataFrame:
    """Daily snapshots, the newest 180 of each user, with the change from the snapshot before."""
    days = M.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("value"))
    own = Window.partitionBy("user_id")
    l = days.withColumns({"before": F.lag("value").over(own.orderBy("day")), "r": F.row_number().over(own.orderBy(F.desc("day")))}).filter("r <= 180")
    change = F.col("value") - F.col("before")
    return l.select("user_id", "day", F.round("value", 2).alias("value"), F.round(change, 2).alias("change"), F.round(change / F.nullif(F.col("before"), F.lit(0.0)), 6).alias("change_pct"))


#: A few days of reference rates with gaps: currency units for a euro.
RATES = (("1998-03-02", "USD", 1.10), ("1998-03-02", "GBP", 0.65), ("1998-03-05", "USD", 1.20), ("1998-03-05", "JPY", 140.0), ("1998-03-20", "USD", 1.15), ("1998-03-20", "GBP", 0.70), ("1998-03-20", "JPY", 138.0))
_RATES = ", ".join(f"(date '{a}', '{b}', {c}::double)" for a, b, c in RATES)


@query(f"""with r(rate_date, currency, per_eur) as (values {_RATES}), usd as (select rate_date, per_eur as usd from r where currency = 'USD'),
s as (select l_orderkey as lot, l_linenumber as line, l_partkey as item_id, l_extendedprice as amount, (['USD', 'EUR', 'GBP', 'JPY', 'CHF'])[(l_suppkey % 5) + 1] as currency, l_shipdate::date as day from lineitem),
j as (select s.*, u.rate_date, u.usd from s asof left join usd u on s.day >= u.rate_date)
select lot, line, item_id, j.currency, amount, case when j.currency = 'USD' then floor(amount + 0.5)::bigint when date_diff('day', j.rate_date, j.day) <= 10 then floor(amount / case when j.currency = 'EUR' then 1.0 else r.per_eur end * usd + 0.5)::bigint end as usd
from j left join r on r.rate_date = j.rate_date and r.currency = j.currency""")
def fx_asof_usd(spark: SparkSession, d: str) -> DataFrame:
    rates = spark.createDataFrame(RATES, "rate_date string, currency string, per_eur double").withColumn("rate_date", F.to_date("rate_date"))
    currency = F.get(F.array(*[F.lit(x) for x in ("USD", "EUR", "GBP", "JPY", "CHF")]), (F.col("source_id") % 5).cast("int"))
    s = M.sales(spark, d).select("lot", "line", "item_id", F.col("price").alias("amount"), currency.alias("currency"), "sold_at")
    return fx.to_usd(s, rates).select("lot", "line", "item_id", "currency", "amount", "usd")


@query(f"with r(rate_date, currency, per_eur) as (values {_RATES}) select count(distinct rate_date) as days, min(rate_date) as first_day, max(rate_date) as last_day from r")
def fx_coverage(spark: SparkSession, d: str) -> DataFrame:
    rates = spark.createDataFrame(RATES, "rate_date string, currency string, per_eur double").withColumn("rate_date", F.to_date("rate_date"))
    return fx.coverage(rates).drop("currencies")


@query(f"with {R.TABLES} select i.item_id, count(*) as related from item i join item o on o.make = i.make and o.model_key = i.model_key and o.item_id <> i.item_id and abs(o.year - i.year) <= 3 group by i.item_id")
def related_model_years(spark: SparkSession, d: str) -> DataFrame:
    a = M.items(spark, d).select("item_id", "make", "model_key", F.explode(F.sequence(F.col("year") - 3, F.col("year") + 3)).alias("year"))
    b = M.items(spark, d).select(F.col("item_id").alias("other"), "make", "model_key", "year")
    return a.join(b, ["make", "model_key", "year"]).filter("other <> item_id").groupBy("item_id").agg(F.count("*").alias("related"))


#: Price-cut pressure needs over two listings and a share of cuts above 0.4.
@query("""with h as (select o_custkey as seller, o_orderkey as listing, first(l_extendedprice order by l_linenumber, l_partkey, l_extendedprice) as a, last(l_extendedprice order by l_linenumber, l_partkey, l_extendedprice) as b, count(*) as k from lineitem join orders on o_orderkey = l_orderkey group by all),
c as (select seller, count(*) as total, count(*) filter (k > 1 and b < a) as cut, list((a - b) / a order by (a - b) / a) filter (k > 1 and b < a) as cuts from h group by seller)
select seller, total, cut, case when total > 2 and cut / total > 0.4 then 'PRICE_CUT_PRESSURE' when total >= 3 and cut = 0 then 'ASKS_HOLDING' end as status, case when total > 2 and cut / total > 0.4 then round(cuts[(cut // 2)::int + 1], 6) when total >= 3 and cut = 0 then 0.0 end as median_cut from c""")
def price_cut_pressure(spark: SparkSession, d: str) -> DataFrame:
    lines = M.table(spark, d, "lineitem").join(M.table(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    order = F.struct("l_linenumber", "l_partkey", "l_extendedprice")
    h = lines.groupBy(F.col("o_custkey").alias("seller"), "o_orderkey").agg(F.min_by("l_extendedprice", order).alias("a"), F.max_by("l_extendedprice", order).alias("b"), F.count("*").alias("k"))
    down = (F.col("k") > 1) & (F.col("b") < F.col("a"))
    c = h.groupBy("seller").agg(F.count("*").alias("total"), F.count_if(down).alias("cut"), F.sort_array(F.collect_list(F.when(down, (F.col("a") - F.col("b")) / F.col("a")))).alias("cuts"))
    pressed = (F.col("total") > 2) & (F.col("cut") / F.col("total") > 0.4)
    holding = (F.col("total") >= 3) & (F.col("cut") == 0)
    return c.select("seller", "total", "cut", F.when(pressed, "PRICE_CUT_PRESSURE").when(holding, "ASKS_HOLDING").alias("status"), F.when(pressed, F.round(F.get("cuts", F.floor(F.col("cut") / 2).cast("int")), 6)).when(holding, 0.0).alias("median_cut"))


