"""Queries of identity: duplicates, keys, titles, evidence, resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as E
from ..operators import dedup, resolve
from . import market as M
from . import market_sql as R

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


@query("select l_orderkey as lot, l_linenumber as line, l_partkey as item_id, l_extendedprice as price from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) as r from lineitem) where r = 1")
def natural_key_dedup(spark: SparkSession, d: str) -> DataFrame:
    first = dedup.first_by(M.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice"))
    return first.select(F.col("l_orderkey").alias("lot"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("item_id"), F.col("l_extendedprice").alias("price"))


def listed_sales(spark: SparkSession, d: str) -> DataFrame:
    """Sales with all that duplicates are judged by; every third has an identification number of its item and mileage."""
    s = M.sales(spark, d)
    source = F.get(F.array(*[F.lit(x) for x in ("bat", "mecum", "hagerty", "classic", "elsewhere")]), (F.col("source_id") % 5).cast("int"))
    vin = F.when(F.col("lot") % 3 == 0, F.concat(F.lit("WDB"), F.lpad(F.col("item_id").cast("string"), 6, "0"), F.lpad((F.col("mileage") / 1000).cast("int").cast("string"), 3, "0")))
    return s.withColumns({
        "sale_id": F.xxhash64("lot", "line", "item_id", "source_id", "price", "sold_at"), "source": source, "vin": vin, "vin_normal": E.normal_vin(vin),
        "url": F.concat(F.lit("https://x.example/lot/"), F.col("lot"), F.lit("/?page=1")), "title": F.concat(F.lit("item "), F.col("item_id"), F.lit(" line "), F.col("line")),
    })


_LISTED = f"""
with {R.TABLES},
listed_sale as (select item_id, lot, line, price, mileage, sold_at, unsold, abroad, source_id, (['bat', 'mecum', 'hagerty', 'classic', 'elsewhere'])[(source_id % 5) + 1] as src, case when lot % 3 = 0 then 'WDB' || lpad(item_id::varchar, 6, '0') || lpad((mileage / 1000)::int::varchar, 3, '0') end as vin, 'item ' || item_id || ' line ' || line as title from sale)
"""
_TRIGRAMS = "list_distinct(list_transform(range(1, len({0}) - 1), lambda i: substr({0}, i, 3)))"




def scored_sql(name: str, which: str) -> str:
    """SQL step ``name``: scored pairs of listed sales within a week for which ``which`` holds."""
    return f"""{name}_p as (select a.item_id, a.lot as a_lot, a.line as a_line, b.lot as b_lot, b.line as b_line, a.price as pa, b.price as pb, a.mileage as ma, b.mileage as mb, a.src as sa, b.src as sb, a.vin as va, b.vin as vb, abs(epoch_us(a.sold_at) - epoch_us(b.sold_at)) / 86400e6 as apart, {_TRIGRAMS.format('a.title')} as ga, {_TRIGRAMS.format('b.title')} as gb
  from listed_sale a join listed_sale b on a.item_id = b.item_id and {which} where abs(epoch_us(a.sold_at) - epoch_us(b.sold_at)) <= 7 * 86400000000),
{name} as (select *, case when a_lot = b_lot and sa = sb then 1.0 when va is not null and vb is not null then case when va = vb then 1.0 else 0.0 end else
  case when abs(pa - pb) / greatest(pa, pb) < 0.005 then 0.45 when abs(pa - pb) / greatest(pa, pb) < 0.02 then 0.2 when abs(pa - pb) / greatest(pa, pb) <= 0.13 then 0.3 else 0.0 end
  + case when apart <= 2 then 0.25 else 0.1 end + case when abs(ma - mb) <= greatest(100.0, 0.01 * ma) then 0.2 else 0.0 end + 0.1 * len(list_intersect(ga, gb)) / (len(ga) + len(gb) - len(list_intersect(ga, gb))) end as score from {name}_p)"""


@query(_LISTED + f""", {scored_sql('s', '(a.lot, a.line, a.price) < (b.lot, b.line, b.price)')}
select item_id, count(*) as pairs, count(*) filter (score >= 0.75) as duplicates, round(sum(score), 4) as total_score from s group by item_id""")
def cross_source_pairs(spark: SparkSession, d: str) -> DataFrame:
    s = listed_sales(spark, d).withColumn("sale_id", F.struct("lot", "line", "price"))
    pairs = dedup.scored_pairs(s)
    return pairs.groupBy("item_id").agg(F.count("*").alias("pairs"), F.count_if(F.col("score") >= E.DUPLICATE).alias("duplicates"), F.round(F.sum("score"), 4).alias("total_score"))


@query()
def duplicate_survivors(spark: SparkSession, d: str) -> DataFrame:
    """Greedy collapse of each item's duplicates: what became of every sale that has one."""
    s = listed_sales(spark, d)
    return dedup.collapsed(s, dedup.scored_pairs(s)).groupBy((F.col("id") == F.col("survivor_id")).alias("survives")).agg(F.count("*").alias("n"))


@query(_LISTED + """, fit as (select *, count(*) over (partition by vin) as n from listed_sale where vin is not null and not unsold and not abroad and price > 0 qualify n > 1)
select vin as vin_key, lot, line, price, n, row_number() over w as nth, lag(price) over w as last_price, (epoch_us(sold_at) - epoch_us(lag(sold_at) over w)) / 86400e6 as days from fit window w as (partition by vin order by sold_at, lot, line, price)""")
def repeat_sales(spark: SparkSession, d: str) -> DataFrame:
    s = listed_sales(spark, d).withColumn("sale_id", F.struct("lot", "line", "price"))
    return dedup.repeat_sales(s).select("vin_key", "lot", "line", "price", "n", F.col("nth").cast("long").alias("nth"), "last_price", "days")


@query(_LISTED.replace("with ", "with ", 1) + """ select a.item_id, a.lot as a_lot, b.lot as b_lot, round(a.price, 2) as a_price, round(b.price, 2) as b_price from listed_sale a join listed_sale b on a.item_id = b.item_id and (a.lot, a.line, a.price) < (b.lot, b.line, b.price) and a.source_id <> b.source_id
where abs(epoch_us(a.sold_at) - epoch_us(b.sold_at)) <= 2 * 86400000000 and abs(a.price - b.price) <= 0.05 * greatest(a.price, b.price)""")
def coincidence_audit(spark: SparkSession, d: str) -> DataFrame:
    """Sales of an item by different sources within two days and five per cent of the price."""
    s = listed_sales(spark, d).select("item_id", "lot", "line", "price", "source_id", "sold_at").withColumn("day", F.floor(F.unix_micros("sold_at") / (2 * 86_400_000_000)))
    a = s.select("item_id", "day", *[F.col(c).alias(f"a_{c}") for c in ("lot", "line", "price", "source_id", "sold_at")])
    b = s.select("item_id", F.explode(F.array(F.col("day") - 1, F.col("day"), F.col("day") + 1)).alias("day"), *[F.col(c).alias(f"b_{c}") for c in ("lot", "line", "price", "source_id", "sold_at")])
    order = lambda p: F.struct(F.col(f"{p}_lot").alias("l"), F.col(f"{p}_line").alias("n"), F.col(f"{p}_price").alias("p"))
    near = F.abs(E.days_before(F.col("a_sold_at"), F.col("b_sold_at"))) <= 2
    pairs = a.join(b, ["item_id", "day"]).filter((order("a") < order("b")) & (F.col("a_source_id") != F.col("b_source_id")) & near & (F.abs(F.col("a_price") - F.col("b_price")) <= 0.05 * F.greatest("a_price", "b_price")))
    return pairs.select("item_id", "a_lot", "b_lot", F.round("a_price", 2).alias("a_price"), F.round("b_price", 2).alias("b_price"))


@query("""with t as (select conv_id, turn, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) as s from conversations),
g as (select *, case when len(s) >= 3 then list_distinct(list_transform(range(1, len(s) - 1), lambda i: substr(s, i, 3))) else [] end as g from t)
select a.conv_id, a.turn, case when len(a.g) = 0 or len(b.g) = 0 then 0.0 else round(len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))), 6) end as similarity from g a join g b on a.conv_id = b.conv_id and b.turn = a.turn + 1""")
def trigram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Trigram similarity of consecutive turns."""
    t = M.table(spark, d, "conversations").select("conv_id", "turn", E.trigrams(F.col("text")).alias("g"))
    after = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("g").alias("h"))
    return t.join(after, ["conv_id", "turn"]).select("conv_id", "turn", F.round(E.set_similarity(F.col("g"), F.col("h")), 6).alias("similarity"))


@query("select page_id, nullif(lower(regexp_replace(regexp_extract(coalesce(url, ''), '^[^?#]*'), '/+$', '')), '') as canonical from pages")
def canonical_urls(spark: SparkSession, d: str) -> DataFrame:
    return M.table(spark, d, "pages").select("page_id", E.canonical_url(F.col("url")).alias("canonical"))


@query("with c as (select nullif(lower(regexp_replace(regexp_extract(coalesce(url, ''), '^[^?#]*'), '/+$', '')), '') as canonical, page_id, html from pages) select canonical, count(*) as n, count(distinct html) as n_titles from c group by canonical having count(*) > 1")
def contradicting_urls(spark: SparkSession, d: str) -> DataFrame:
    """Canonical urls that several pages share, and how many different contents they have."""
    p = M.table(spark, d, "pages").select(E.canonical_url(F.col("url")).alias("canonical"), "html")
    return p.groupBy("canonical").agg(F.count("*").alias("n"), F.countDistinct("html").alias("n_titles")).filter("n > 1")


#: Identification numbers as found in the wild, with a claimed year.
VINS = (("WDBSK75F56F107641", 2006), ("wdd-aj76f96m001144", 2012), ("VIN", 1990), ("00000000000", 1990), ("118.000 002763", 1961), ("ABCDEFGH", 2000), ("1G1YY22G965104378", 1996), ("WP0ZZZ99ZTS392124", 1996), ("1FTIOQ22G96510437", 1996), ("12", 1950), (None, 1970))
_VINS = ", ".join(f"({i}, {R.text(v) if v else 'null'}, {y})" for i, (v, y) in enumerate(VINS))


@query(rf"""with r(id, raw, year) as (values {_VINS}), a as (select id, year, regexp_replace(upper(raw), '[^A-Z0-9]', '', 'g') as v from r),
n as (select id, year, case when len(v) between 5 and 17 and v not in ({', '.join(map(R.text, E.NO_VIN))}) and regexp_matches(v, '[0-9]') and v <> repeat(v[1], len(v)) then v end as vin from a),
y as (select *, coalesce(len(vin) >= 11 and (len(vin) <> 17 or not regexp_matches(vin, '[IOQ]')), false) as valid, case when len(vin) = 17 then nullif(strpos('{E.VIN_YEARS}', vin[10]), 0) end as code from n)
select id, vin, valid, 1979 + code as first_year, 2009 + code as second_year, coalesce(abs(1979 + code - year) <= 1 or abs(2009 + code - year) <= 1, true) as plausible from y""")
def vin_normalise(spark: SparkSession, d: str) -> DataFrame:
    r = spark.createDataFrame([(i, v, y) for i, (v, y) in enumerate(VINS)], "id int, raw string, year int")
    raw = F.col("raw")
    years = E.vin_years(raw)
    return r.select("id", E.normal_vin(raw).alias("vin"), E.valid_vin(raw).alias("valid"), F.get(years, F.lit(0)).cast("long").alias("first_year"), F.get(years, F.lit(1)).cast("long").alias("second_year"), E.vin_year_plausible(raw, F.col("year")).alias("plausible"))


@query(r"""with t as (select p_partkey as item_id, list_transform(string_split(p_name || ' ' || p_type || ' l-82 Mercedes-Benz the', ' '), lambda x: regexp_replace(lower(x), '[^a-z0-9/.\-]', '', 'g')) as w from part),
u as (select item_id, list_transform(w, lambda x: case when contains(x, '-') and (regexp_matches(x, '\d') or len(list_filter(string_split(x, '-'), lambda p: len(p) between 1 and 2)) > 0) then replace(x, '-', '') else x end) as w from t)
select item_id, array_to_string(list_sort(list_distinct(list_filter(w, lambda x: x not in ('', 'the', 'a', 'an', 'with', 'and', 'for', 'w', 'automatic', 'auto', 'manual', 'stick', 'tiptronic', 'pdk', 'dct', 'speed')))), ' ') as model_key from u""")
def model_key_canonical(spark: SparkSession, d: str) -> DataFrame:
    words = F.split(F.concat_ws(" ", "p_name", "p_type", F.lit("l-82 Mercedes-Benz the")), " ")
    return M.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), resolve.model_key(words).alias("model_key"))


@query()
def model_key_compare(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of names under one type: how many are the same, different or doubtful."""
    names = M.table(spark, d, "part").select("p_type", resolve.model_key(F.split("p_name", " ")).alias("k")).distinct()
    a, b = names.select("p_type", F.col("k").alias("a")), names.select("p_type", F.col("k").alias("b"))
    return a.join(b, "p_type").filter("a < b").groupBy(resolve.compare_keys(F.col("a"), F.col("b")).alias("verdict")).agg(F.count("*").alias("n"))


#: Makes that stand for brands in made-up titles; the last is not in the vocabulary.
TITLE_MAKES = ("Porsche", "Ferrari", "BMW", "Mercedes-Benz", "Citroën", "Alfa Romeo", "Land Rover", "Qwertz")
TITLE_BODIES = ("", " Coupe", " Convertible", " 3.0L Coupe")


def titled(spark: SparkSession, d: str) -> DataFrame:
    """Records with titles made of parts: year, make, name, size class and at times body and displacement."""
    pick = lambda xs, c: F.get(F.array(*[F.lit(x) for x in xs]), F.pmod(c, F.lit(len(xs))).cast("int"))
    brand = F.regexp_extract("p_brand", r"\d+", 0).cast("int")
    title = F.concat(F.when(F.col("p_partkey") % 7 == 0, "28k-Mile ").otherwise(""), F.col("p_size") % 30 + 1960, F.lit(" "), pick(TITLE_MAKES, brand), F.lit(" "), F.initcap("p_name"), F.lit(" "), F.col("p_size") % 3 + 1, F.lit("00"), pick(TITLE_BODIES, F.col("p_partkey") % 11), F.when(F.col("p_partkey") % 13 == 0, " Chassis no. 1192006").otherwise(""))
    return M.table(spark, d, "part").select(F.col("p_partkey").alias("ordinal"), title.alias("title"), F.lit(None).cast("string").alias("url"), F.concat(F.lit("s"), F.col("p_partkey") % 4).alias("source"))


@query()
def title_parse(spark: SparkSession, d: str) -> DataFrame:
    return resolve.parsed_titles(titled(spark, d), 2003).select("ordinal", "ok", "year", "make", "model_key", "body", "displacement", "make_inferred")


@query(r"""with r as (select p_partkey as ordinal, p_brand as make, p_type || ' ' || p_name as words, p_size as year, 's' || (p_partkey % 4) as source from part),
k as (select *, array_to_string(list_sort(list_distinct(string_split(lower(words), ' '))), ' ') as model_key from r),
acc as (select * from k where ordinal % 5 = 0), inc as (select * from k where ordinal % 5 <> 0),
seen as (select make, count(*) as sightings, count(distinct source) as sources from acc group by make), bat as (select make, count(*) as n, count(distinct year) as years, count(distinct model_key) as models from inc group by make),
tok as (select 'a' as side, unnest(string_split(model_key, ' ')) as t from acc union all select 'b', unnest(string_split(model_key, ' ')) from inc), rec as (select distinct t from (select t from tok group by side, t having count(*) > 1)),
keys as (select distinct make, model_key from inc), share as (select make, model_key, count(rec.t) / count(*) as s from (select make, model_key, unnest(string_split(model_key, ' ')) as t from keys) x left join rec using (t) group by all),
e as (select keys.*, case when coalesce(sightings, 0) >= 3 then 0.5 when sightings > 0 then 0.2 when coalesce(n, 0) >= 8 and years >= 4 and models >= 2 then 0.5 when n > 0 then 0.1 else 0.0 end + case when coalesce(sources, 0) >= 2 then 0.3 when sources = 1 then 0.1 else 0.0 end + 0.2 * coalesce(s, 0) as score from keys left join seen using (make) left join bat using (make) left join share using (make, model_key))
select make, model_key, round(least(1.0, score), 6) as score, case when score >= 0.6 then 'strong' when score >= 0.25 then 'weak' else 'none' end as level from e""")
def evidence_levels(spark: SparkSession, d: str) -> DataFrame:
    """Parts of numbers 0 modulo 5 are in the index already, the others arrive."""
    r = M.table(spark, d, "part").select(F.col("p_partkey").alias("ordinal"), F.col("p_brand").alias("make"), F.array_join(F.array_sort(F.array_distinct(F.split(F.lower(F.concat_ws(" ", "p_type", "p_name")), " "))), " ").alias("model_key"), F.col("p_size").alias("year"), F.concat(F.lit("s"), F.col("p_partkey") % 4).alias("source"))
    e = resolve.evidence(r.filter("ordinal % 5 <> 0"), r.filter("ordinal % 5 = 0"))
    return e.select("make", "model_key", F.round("score", 6).alias("score"), "level")


@query()
def blocked_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Made-up titles parsed, decided and resolved: what became of them."""
    parsed = resolve.parsed_titles(titled(spark, d), 2003)
    scored = resolve.evidence(parsed.filter("ok"), parsed.filter("ok and ordinal % 5 = 0"))
    done = resolve.resolve(resolve.decided(parsed, scored).filter("ok and action = 'accept'"))
    return done.groupBy("decision").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("items"))


@query("select make, n from (values ('Porsche', 1)) t(make, n) where false union all select lower(p_brand) as make, count(distinct case when p_partkey % 2 = 0 then p_brand else lower(p_brand) end) as n from part group by 1 having count(distinct case when p_partkey % 2 = 0 then p_brand else lower(p_brand) end) > 1")
def casing_families(spark: SparkSession, d: str) -> DataFrame:
    """Makes spelled in more than one case (every other part has its brand in lower case)."""
    spelled = F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(F.lower("p_brand"))
    return M.table(spark, d, "part").select(spelled.alias("make_")).groupBy(F.lower("make_").alias("make")).agg(F.countDistinct("make_").alias("n")).filter("n > 1")


@query("""with i as (select p_partkey as id, p_brand as make, p_type as model_key, p_size as year, case when p_partkey % 3 = 0 then p_name end as body from part)
select a.id as blank_id, b.id as stated_id, b.body from i a join i b on a.make = b.make and a.model_key = b.model_key and a.year = b.year and a.id <> b.id where a.body is null and b.body is not null""")
def null_attribute_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Items equal but for an attribute that one states and the other does not."""
    i = M.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("make"), F.col("p_type").alias("model_key"), F.col("p_size").alias("year"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).alias("body"))
    blank, stated = i.filter("body is null").withColumnRenamed("id", "blank_id").drop("body"), i.filter("body is not null").withColumnRenamed("id", "stated_id")
    return blank.join(stated, ["make", "model_key", "year"]).select("blank_id", "stated_id", "body")


