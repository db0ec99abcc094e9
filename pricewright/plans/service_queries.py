"""Queries of the store, the review queue, the garage, listings and harvests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expr as E
from ..operators import dedup, garage, publish, quality, stored, tables
from ..operators import valuation as V
from . import market as M
from . import market_sql as R
from .identity_queries import _LISTED, listed_sales, scored_sql
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


# a batch against the store


def store_and_batch(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Sales of lots of even number are stored, the others come as a batch."""
    s = listed_sales(spark, d).withColumn("sale_id", F.concat_ws("-", "lot", "line", F.format_string("%.2f", "price"))).withColumn("transmission", F.lit(None).cast("string"))
    return s.filter("lot % 2 = 0"), s.filter("lot % 2 = 1")


def _taken_in_sql() -> str:
    trust = "(case {0} when 'bat' then 1 when 'mecum' then 1 when 'hagerty' then 2 when 'classic' then 9 else 5 end)"
    ids = "a_lot || '-' || a_line || '-' || printf('%.2f', pa) as a_id, b_lot || '-' || b_line || '-' || printf('%.2f', pb) as b_id"
    steps = [
        scored_sql("w", "a.lot % 2 = 1 and b.lot % 2 = 1 and (a.lot, a.line, a.price) < (b.lot, b.line, b.price)"),
        # ids are texts: who stands first among equals of a batch is told by them
        f"w1 as (select *, {ids}, {trust.format('sa')} as ta, {trust.format('sb')} as tb from w where score >= 0.75)",
        "lost as (select distinct case when a_id < b_id then case when ta <= tb then b_id else a_id end else case when tb <= ta then a_id else b_id end end as id from w1)",
        scored_sql("x", "a.lot % 2 = 1 and b.lot % 2 = 0"),
        f"r as (select {ids}, {trust.format('sa')} as ta, {trust.format('sb')} as tb from x where score >= 0.75), rv as (select * from r where a_id not in (select id from lost))",
        "g0 as (select '' as id where false)",
    ]
    levels = sorted({*E.SOURCE_TRUST.values(), E.OTHER_TRUST})
    for i, level in enumerate(levels):
        steps.append(f"d{i + 1} as (select distinct a_id as id from rv where ta = {level} and tb <= {level} and b_id not in (select id from g{i}))")
        steps.append(f"g{i + 1} as (select id from g{i} union select b_id from rv where ta = {level} and tb > {level} and a_id not in (select id from d{i + 1}))")
    n = len(levels)
    steps.append("gone as (select id, 'dropped' as outcome from lost union all " + " union all ".join(f"select id, 'dropped' from d{i + 1}" for i in range(n)) + f" union all select id, 'replaced' from g{n})")
    return _LISTED + ", " + ", ".join(steps)


@query(_taken_in_sql() + " select id, outcome from gone")
def ingest_against_stored(spark: SparkSession, d: str) -> DataFrame:
    """A batch meets what is stored: sales of it that are dropped, and stored ones that a more trusted source replaces."""
    out = stored.taken_in(*store_and_batch(spark, d))
    return out["dropped"].withColumn("outcome", F.lit("dropped")).union(out["replaced"].withColumn("outcome", F.lit("replaced")))


@query(_taken_in_sql() + " select (select count(*) from listed_sale where lot % 2 = 0) as stored, (select count(*) from listed_sale) - (select count(*) from gone) as after_once, (select count(*) from listed_sale) - (select count(*) from gone) as after_twice, 0 as changed")
def ingest_twice(spark: SparkSession, d: str) -> DataFrame:
    """A batch taken in twice: the second time changes no row. Lines of one order, number and price share an id, and all are kept."""
    stored_, batch = store_and_batch(spark, d)
    old, new = (dedup.numbered(s, ["lot", "line", "price"], "item_id", "source_id", "sold_at", "mileage", "status") for s in (stored_, batch))
    once = tables.written(stored.taken_in(old, new, copy="copy")["sales"], "once")
    twice = tables.written(stored.taken_in(once, new, copy="copy")["sales"], "twice")
    own = ["sale_id", "copy"]
    changed = publish.changed_keys(twice, once, own).union(publish.deleted_keys(twice, once, own))
    one = lambda df, name: F.broadcast(df.agg(F.count("*").alias(name)))
    return stored_.agg(F.count("*").alias("stored")).join(one(once, "after_once")).join(one(twice, "after_twice")).join(one(changed, "changed"))


# listings

_LISTING = """
old as (select l_orderkey as lot, l_linenumber as line, l_partkey as item_id, l_extendedprice as price, case when l_linenumber % 3 = 0 then 'EUR' end as currency, l_quantity * 1000 as mileage from lineitem where l_linenumber % 2 = 1),
new as (select l_orderkey as lot, l_linenumber as line, l_partkey as item_id, l_extendedprice * (1 - l_discount) as price, case when l_linenumber % 5 = 0 then l_quantity * 1000 + 1 end as mileage, l_returnflag = 'N' as is_active, case when l_returnflag = 'A' then 1.0 end as estimate_low from lineitem where l_linenumber % 4 <> 3),
n as (select *, case when estimate_low is not null then 'auction' else 'classified' end as listing_type, case when is_active then 'live' else 'unknown' end as listing_status, case when estimate_low is not null then 'estimate' else 'asking' end as price_type from new)
"""


@query(f"""with {_LISTING} select coalesce(o.lot, n.lot) as lot, coalesce(o.line, n.line) as line, coalesce(o.item_id, n.item_id) as item_id, case when n.lot is not null then n.price else o.price end as price,
case when n.lot is not null then 'USD' else coalesce(o.currency, 'USD') end as currency, coalesce(n.mileage, o.mileage) as mileage, case when n.lot is not null then n.is_active else true end as is_active,
case when n.lot is not null then n.listing_type else 'classified' end as listing_type, case when n.lot is not null then n.listing_status else 'live' end as listing_status, case when n.lot is not null then n.price_type else 'asking' end as price_type,
case when o.lot is not null then 1 else 2 end as first_run, case when n.lot is not null then 2 else 1 end as last_run from old o full join n on o.lot = n.lot and o.line = n.line""")
def listing_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Stored listings after a second sighting: states are set anew, descriptors filled in, the first sighting's time kept."""
    line = M.table(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("lot"), F.lit("s").alias("source"), F.col("l_orderkey").alias("lot_"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("item_id"), "l_extendedprice", "l_discount", "l_quantity", "l_returnflag")
    first, second = (F.lit(f"2001-01-0{i} 00:00:00").cast("timestamp") for i in (1, 2))
    keys = ["source", "lot", "lot_", "line", "item_id"]
    old = line.filter("line % 2 = 1").select(*keys, F.col("l_extendedprice").alias("price"), F.when(F.col("line") % 3 == 0, "EUR").alias("currency"), (F.col("l_quantity") * 1000).alias("mileage"), F.lit(True).alias("is_active"), F.lit(None).cast("double").alias("estimate_low"))
    new = line.filter("line % 4 <> 3").select(*keys, (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price"), F.when(F.col("line") % 5 == 0, F.col("l_quantity") * 1000 + 1).alias("mileage"), (F.col("l_returnflag") == "N").alias("is_active"), F.when(F.col("l_returnflag") == "A", 1.0).alias("estimate_low"))
    after = stored.listings_after(stored.listing_state(old, first), new, second)
    return after.select(F.col("lot_").alias("lot"), "line", "item_id", "price", "currency", "mileage", "is_active", "listing_type", "listing_status", "price_type", F.day("first_seen_at").alias("first_run"), F.day("last_seen_at").alias("last_run"))


# review queue

_RAW = """case when o_orderkey % 7 = 0 then '{"title": ' when o_orderkey % 7 = 1 then 'null' when o_orderkey % 7 = 2 then '[1, 2]' when o_orderkey % 7 = 3 then '{"title": "x", "price": 5}' else '{"title": "x", "sold_at": null}' end"""
_QUEUE = f"q as (select 's' || (o_custkey % 3) as source, o_orderkey as lot, (['pending', 'rejected', 'resolved', 'duplicate'])[o_orderkey % 4 + 1] as status, case when o_orderkey % 5 = 0 then 'listing' end as kind, {_RAW} as raw, o_orderdate as created_at from orders)"


def review_queue(spark: SparkSession, d: str) -> DataFrame:
    """Orders as rows of a review queue, some with raw records that cannot be read."""
    key = F.col("o_orderkey")
    raw = F.when(key % 7 == 0, '{"title": ').when(key % 7 == 1, "null").when(key % 7 == 2, "[1, 2]").when(key % 7 == 3, '{"title": "x", "price": 5}').otherwise('{"title": "x", "sold_at": null}')
    status = F.get(F.array(*[F.lit(x) for x in ("pending", "rejected", "resolved", "duplicate")]), (key % 4).cast("int"))
    return M.table(spark, d, "orders").select(F.concat(F.lit("s"), F.col("o_custkey") % 3).alias("source"), key.alias("lot"), status.alias("status"), F.when(key % 5 == 0, "listing").alias("kind"), raw.alias("raw_record"), F.col("o_orderdate").alias("created_at"))


@query(f"with {_QUEUE} select coalesce(kind, case when list_contains(json_keys(raw), 'sold_at') then 'sale' else 'listing' end) as kind, status, count(*) as n from q where status in ('pending', 'rejected') and json_valid(raw) and json_type(raw) = 'OBJECT' group by all")
def queue_replay(spark: SparkSession, d: str) -> DataFrame:
    """What of the review queue can be run through ingestion again, by kind; rows that cannot be read are passed over."""
    return stored.replayable(review_queue(spark, d)).groupBy("kind", "status").agg(F.count("*").alias("n"))


@query(f"""with {_QUEUE}, there as (select distinct 's' || (l_suppkey % 3) as source, l_orderkey as lot from lineitem where l_returnflag <> 'R'),
a as (select case when q.status in ('pending', 'rejected') and there.lot is not null then 'resolved' else q.status end as after, q.status as before from q left join there using (source, lot))
select status, coalesce(b, 0) as before, coalesce(c, 0) as after, coalesce(c, 0) - coalesce(b, 0) as change from (select before as status, count(*) as b from a group by 1) full join (select after as status, count(*) as c from a group by 1) using (status)""")
def queue_cleared(spark: SparkSession, d: str) -> DataFrame:
    """The review queue by state, before and after rows of lots stored by now are resolved."""
    queue = review_queue(spark, d)
    there = M.sales(spark, d).filter("not reserve_not_met").select(F.concat(F.lit("s"), F.col("source_id") % 3).alias("source"), "lot")
    return stored.counts_between(queue, stored.cleared(queue, there), "status")


@query(f"with {_QUEUE} select source, lot, created_at from q where status = 'pending' order by created_at desc, source, lot limit 50")
def queue_newest(spark: SparkSession, d: str) -> DataFrame:
    """The 50 newest pending rows of the review queue."""
    return review_queue(spark, d).filter("status = 'pending'").orderBy(F.desc("created_at"), "source", "lot").limit(50).select("source", "lot", "created_at")


# garage


@query("""with c as (select user_id, event_id, ts, case event_type when 'signup' then 'create' when 'error' then 'archive' else 'patch' end as action, case when event_type <> 'view' then value end as mileage from events)
select user_id, max_by(mileage, (ts, event_id)) filter (mileage is not null) as mileage, case when max_by(action, (ts, event_id)) = 'archive' then 'archived' else 'owned' end as status, min(ts) as created_at, max(ts) as updated_at from c group by user_id""")
def garage_latest(spark: SparkSession, d: str) -> DataFrame:
    """Holdings by the changes made to them, in the order a garage lists them."""
    kind = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "error", "archive").otherwise("patch")
    c = M.table(spark, d, "events").select("user_id", "event_id", "ts", kind.alias("action"), F.when(F.col("event_type") != "view", F.col("value")).alias("mileage"))
    return garage.in_garage_order(garage.latest(c, "user_id", "ts", "event_id", ["mileage"]), "user_id").select("user_id", "mileage", "status", "created_at", "updated_at")


_ENTERED = """e as (select p_partkey as id, case when p_partkey % 9 = 0 then '' when p_partkey % 9 = 1 then '  ' else ' ' || p_name || ' ' end as name, case p_partkey % 5 when 0 then null when 1 then '1999-02-' || lpad((p_size % 40)::varchar, 2, '0') when 2 then 'soon' when 3 then '' else '2001-12-31' end as day,
case p_partkey % 6 when 0 then null when 1 then p_size::varchar when 2 then '-' || (p_size + 1) when 3 then (p_size || '.5') when 4 then 'many' else '' end as miles, case p_partkey % 4 when 0 then null when 1 then '[" ' || p_name || ' ", "", "x"]' when 2 then '[1, "x"]' else '{"a": "b"}' end as options from part)"""


@query(f"""with {_ENTERED}, v as (select id, case when length(trim(name)) <= 10 then nullif(trim(name), '') end as name, case when length(trim(name)) > 10 then 'name is too long' end as name_error,
try_cast(case when regexp_matches(coalesce(day, ''), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then day end as date) as day, case when coalesce(day, '') = '' then null when not regexp_matches(day, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then 'day must be YYYY-MM-DD' when try_cast(day as date) is null then 'day is not a real date' end as day_error,
case when regexp_matches(coalesce(miles, ''), '^\\d+$') then miles::bigint end as miles, case when coalesce(miles, '') <> '' and not regexp_matches(miles, '^\\d+$') then 'miles must be a non-negative whole number' end as miles_error,
case when options is null then '' when starts_with(options, '[" ') then trim(substr(options, 4, length(options) - 14)) || ',x' end as options, case when options is not null and not starts_with(options, '[" ') then 'options must be an array of text values' end as options_error from e) select * from v""")
def garage_input(spark: SparkSession, d: str) -> DataFrame:
    """What holders enter, cleaned, with what is wrong with it."""
    pick, key, size = (lambda n: F.col("p_partkey") % n), F.col("p_partkey"), F.col("p_size")
    name = F.when(pick(9) == 0, "").when(pick(9) == 1, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" ")))
    day = F.when(pick(5) == 1, F.concat(F.lit("1999-02-"), F.lpad((size % 40).cast("string"), 2, "0"))).when(pick(5) == 2, "soon").when(pick(5) == 3, "").when(pick(5) == 4, "2001-12-31")
    miles = F.when(pick(6) == 1, size.cast("string")).when(pick(6) == 2, F.concat(F.lit("-"), size + 1)).when(pick(6) == 3, F.concat(size, F.lit(".5"))).when(pick(6) == 4, "many").when(pick(6) == 5, "")
    options = F.when(pick(4) == 1, F.concat(F.lit('[" '), "p_name", F.lit(' ", "", "x"]'))).when(pick(4) == 2, '[1, "x"]').when(pick(4) == 3, '{"a": "b"}')
    entered = M.table(spark, d, "part").select(key.alias("id"), name.alias("name"), day.alias("day"), miles.alias("miles"), options.alias("options"))
    cleaned = {"name": garage.clean_text(F.col("name"), 10, "name"), "day": garage.clean_date(F.col("day"), "day"), "miles": garage.clean_integer(F.col("miles"), "miles"), "options": garage.clean_options(F.col("options"))}
    found = entered.select("id", *[x.alias(n) for field, pair in cleaned.items() for n, x in zip((field, f"{field}_error"), pair)])
    return found.withColumn("options", F.array_join("options", ","))


@query("""with old as (select o_custkey as user_id, o_orderdate::date as day, sum(o_totalprice) as value from orders where o_orderkey % 3 > 0 group by all), new as (select o_custkey as user_id, o_orderdate::date as day, sum(o_totalprice) as value from orders where o_orderkey % 3 < 2 group by all)
select user_id, day, round(coalesce(new.value, old.value), 2) as value from old full join new using (user_id, day)""")
def garage_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Daily snapshots of holders with a second run: one for each day, the later run's value."""
    days = lambda which: M.table(spark, d, "orders").filter(which).groupBy(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("value"))
    return garage.snapshots_after(days("o_orderkey % 3 > 0"), days("o_orderkey % 3 < 2"), ["user_id", "day"], ["value"]).withColumn("value", F.round("value", 2))


# boards and probes


@query(R.own(R.GROUPED) + " select signal, count(*) as n from v4 where signal is not null group by signal")
def market_health(spark: SparkSession, d: str) -> DataFrame:
    """Items by what their trend says."""
    return own_values(spark, d).filter("signal is not null").groupBy("signal").agg(F.count("*").alias("n"))


@query(R.own(R.GROUPED) + """, m as (select avg(annual_return) as mu from v4)
select item_id, current_value, round(annual_return, 6) as annual_return, sales_count from v4, m where signal = 'bottomed' and current_value >= 5000 order by mu + (trend_lcb - mu) * (greatest(trend_df, 0) / (greatest(trend_df, 0) + 25.0)) desc nulls last, item_id limit 12""")
def bottomed(spark: SparkSession, d: str) -> DataFrame:
    """Items whose fall has ended, the best trend first."""
    v = V.with_trend_score(own_values(spark, d)).filter("signal = 'bottomed' and current_value >= 5000")
    return v.orderBy(F.desc_nulls_last("trend_score"), "item_id").limit(12).select("item_id", "current_value", *r6("annual_return"), "sales_count")


@query(f"with {R.TABLES} select 'items' as name, count(*) as n from item union all select 'sales', count(*) from sale union all select 'listings', count(*) from listing")
def row_probe(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each table that is served."""
    tables = {"items": M.items, "sales": M.sales, "listings": M.listings}
    counts = [t(spark, d).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()]
    return counts[0].union(counts[1]).union(counts[2])


@query(f"with {R.TABLES} select item_id, lot, line, price, sold_at from sale where price is not null and not unsold and epoch_us({R.AS_OF}) - epoch_us(sold_at) <= 730 * 86400000000")
def chart_points(spark: SparkSession, d: str) -> DataFrame:
    """Sales that a price chart of two years shows: transactions only, by date."""
    s = M.sales(spark, d).filter("price is not null and status <> 'reserve_not_met'").filter(E.days_before(M.as_of(), F.col("sold_at")) <= 730)
    return s.orderBy("sold_at", "item_id", "lot", "line").select("item_id", "lot", "line", "price", "sold_at")


@query("""select o_orderkey as lot, o_orderdate >= date '1997-01-01' and o_orderdate < date '1998-07-01' as closed, coalesce(try_cast(nullif(regexp_extract('lot ' || (o_orderkey % 3000) || ' of ' || year(o_orderdate), '(?:19|20)\\d{2}'), '') as int) between 1997 and 1998, false) as named,
epoch_us(timestamp '1998-08-02') - epoch_us(o_orderdate) between 0 and 90 * 86400000000 as recent from orders""")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Sales by the windows that harvests look at: by date, by the year in a name, by age."""
    first, last = F.lit("1997-01-01").cast("timestamp"), F.lit("1998-06-30").cast("timestamp")
    name = F.concat(F.lit("lot "), F.col("o_orderkey") % 3000, F.lit(" of "), F.year("o_orderdate"))
    at = F.col("o_orderdate").cast("timestamp")
    return M.table(spark, d, "orders").select(F.col("o_orderkey").alias("lot"), E.within(at, first, last).alias("closed"), E.year_within(name, first, last).alias("named"), E.aged_at_most(at, F.lit("1998-08-02").cast("timestamp"), 90).alias("recent"))


# harvests


@query("""with s as (select coalesce(source, '') as source, count(*) as n, count(*) filter (text is null or trim(text) = '') as invalid, avg(case when lang is not null and lang <> '' then 1.0 else 0.0 end) as share from documents group by 1)
select source, n, invalid, 0.9 - share > 0.35 as drifted, n < 5 as low, case when invalid > 0 or 0.9 - share > 0.35 or n < 5 then 'NEEDS_REVIEW' else 'OK' end as status from s""")
def health_report(spark: SparkSession, d: str) -> DataFrame:
    """Of each source: records, invalid ones, drift against a baseline, and what follows for it."""
    h = M.table(spark, d, "documents").select(F.coalesce("source", F.lit("")).alias("source"), F.col("doc_id").alias("lot"), F.col("text").alias("title"), "lang", F.lit("2001-01-01").cast("timestamp").alias("sold_at"), F.lit(1.0).alias("price"), F.lit(None).cast("string").alias("status"), F.lit(None).cast("double").alias("mileage"))
    named = h.withColumn("source", F.concat(F.lit("x"), "source"))  # a source without a name is judged, not refused
    now = quality.population(named, ["lang"])
    base = now.select("source", "field", F.lit(0.9).alias("base_share"))
    report = quality.health(named, quality.drift(now, base), M.as_of())
    return report.withColumn("source", F.substring("source", 2, 1000)).select("source", "n", "invalid", "drifted", "low", "status")


_HARVESTS = "a as (select page_id % 700 as key, page_id, url from pages where page_id % 3 < 2), b as (select page_id % 700 as key, page_id, url from pages where page_id % 3 > 0)"


@query(f"with {_HARVESTS} select url, 'first only' as run from (select url from a except select url from b) union all select url, 'second only' from (select url from b except select url from a)")
def harvest_difference(spark: SparkSession, d: str) -> DataFrame:
    """Urls that only one of two harvests has."""
    p = M.table(spark, d, "pages").select("page_id", "url")
    a, b = p.filter("page_id % 3 < 2").select("url"), p.filter("page_id % 3 > 0").select("url")
    return a.subtract(b).withColumn("run", F.lit("first only")).union(b.subtract(a).withColumn("run", F.lit("second only")))


@query(f"with {_HARVESTS} select key, page_id, url from (select *, row_number() over (partition by key order by run desc, key desc, page_id desc, url desc) as r from (select *, 0 as run from a union all select *, 1 from b)) where r = 1")
def harvest_union(spark: SparkSession, d: str) -> DataFrame:
    """Two harvests by key: the later one's row stands."""
    p = M.table(spark, d, "pages").select((F.col("page_id") % 700).alias("key"), "page_id", "url")
    return stored.last_wins([p.filter("page_id % 3 < 2"), p.filter("page_id % 3 > 0")], ["key"])


@query("""with g as (select coalesce(lang, '') as lang, coalesce(source, '') as source, count(*) as n from documents group by all), w as (select g.*, s.sort, s.place from g, (values ('td', 0), ('pa', 1), ('pd', 2)) s(sort, place))
select lang, source, sort, row_number() over (order by n, lang, source, place) as place from w""")
def partition_worklist(spark: SparkSession, d: str) -> DataFrame:
    """Partitions of a harvest by size, the smallest first, each in the three sort orders in turn."""
    sizes = M.table(spark, d, "documents").groupBy(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    work = sizes.withColumn("turn", F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(s).alias("sort")) for i, s in enumerate(("td", "pa", "pd"))])))
    # one row for each partition and order: few, whatever the harvest
    return work.select("lang", "source", "turn.sort", F.row_number().over(Window.orderBy("n", "lang", "source", "turn.place")).cast("long").alias("place"))


@query(f"with {R.TABLES} select lot, line, price, unsold from sale where mileage < 20000 order by unsold, sold_at desc, lot, line, price limit 200")
def detail_worklist(spark: SparkSession, d: str) -> DataFrame:
    """What a budget of 200 fetches is spent on: sold lots first, the newest of them first."""
    s = M.sales(spark, d).filter("mileage < 20000")
    return s.orderBy("reserve_not_met", F.desc("sold_at"), "lot", "line", "price").limit(200).select("lot", "line", "price", F.col("reserve_not_met").alias("unsold"))


@query(r"""with m as (select o_custkey as user_id, list(distinct month(o_orderdate) order by month(o_orderdate)) as months, count(*) as n from orders group by 1)
select user_id, case when n >= 12 then '[' || array_to_string(months, ',') || ']' end as stored_json, case when n >= 12 then len(months) else 0 end as n_read from m""")
def json_columns(spark: SparkSession, d: str) -> DataFrame:
    """Lists stored as JSON: null if there is nothing to tell, never the texts null or []; read again, null is an empty list."""
    months = M.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.array_sort(F.collect_set(F.month("o_orderdate"))).alias("months"), F.count("*").alias("n"))
    kept = months.withColumn("stored_json", E.json_or_null(F.when(F.col("n") >= 12, F.col("months"))))
    return kept.select("user_id", "stored_json", F.size(E.json_list(F.col("stored_json"), "int")).cast("long").alias("n_read"))
