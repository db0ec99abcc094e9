"""What must not grow with the tables: rows that a plan repeats before it shuffles them."""

import datetime
import random
import re

from pyspark.sql import functions as F

from pricewright.functions import stats as S
from pricewright.operators import dedup, ingest, publish, resolve, stored
from pricewright.operators import valuation as V
from pricewright.plans import audit_queries, catalogue
from pricewright.plans import market as M
from tests.conftest import SF
from tests.test_stored import SALE, sale


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_pairs_take_one_shuffle(spark):
    """Sales meet by item; none is repeated for the days it reaches before it is shuffled."""
    rows = [sale("bat", "1", 1), sale("mecum", "2", 1), sale("hagerty", "3", 8), sale("hagerty", "4", 9), sale("bat", "5", 1, item=2), sale("bat", "6", 1, item=None), sale("bat", "7", 1, sold_at=None)]
    sales = spark.createDataFrame(rows, SALE)
    pairs = dedup.scored_pairs(sales)
    assert exchanges(pairs) == 1
    found = {(r.a_id, r.b_id) for r in pairs.collect()}
    assert found == {("bat::1", "mecum::2"), ("bat::1", "hagerty::3"), ("hagerty::3", "mecum::2"), ("hagerty::3", "hagerty::4")}
    met = stored.rivals(sales, spark.createDataFrame([sale("classic", "8", 8), sale("bat", "1", 1)], SALE))
    assert exchanges(met) == 1
    # nos. 4 and 1 are eight days apart; what has no item or no date meets nothing
    assert {(r.a_id, r.b_id) for r in met.collect()} == {("bat::1", "classic::8"), ("mecum::2", "classic::8"), ("hagerty::3", "classic::8"), ("hagerty::4", "classic::8"), ("mecum::2", "bat::1"), ("hagerty::3", "bat::1")}


def test_changed_keys_tell_which_column_is_null(spark):
    schema = "k int, a string, b string, d timestamp"
    day = datetime.datetime(2024, 1, 1)
    old = spark.createDataFrame([(1, "x", None, day), (2, "x", "y", day), (3, None, None, None)], schema)
    new = spark.createDataFrame([(1, None, "x", day), (2, "x", "y", day), (3, None, None, None), (4, "n", None, day)], schema)
    assert sorted(r.k for r in publish.changed_keys(new, old, ["k"]).collect()) == [1, 4]


def test_window_totals_are_those_of_its_rows(spark):
    """Sales are summed up before they reach other items: no join of sales with the items that borrow them."""
    sales, items = M.sales(spark, SF), M.items(spark, SF)
    rows = V.window_scope(sales, items).groupBy("item_id").agg(F.count("*").alias("pool"), F.round(F.avg("price"), 3).alias("price"), F.round(F.avg("mileage"), 3).alias("miles"), F.min("sold_at").alias("first"), F.max("sold_at").alias("last"))
    totals = V.window_totals(sales, items).select("item_id", "pool", F.round(F.col("price_sum") / F.col("price_n"), 3), F.round(F.col("mileage_sum") / F.col("mileage_n"), 3), "first_sale", "last_sale")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, totals.collect()))
    text = plan(catalogue.QUERIES["model_window_pool"](spark, SF))
    scan, repeated = text.index("Scan parquet", text.index("explode(sequence")), text.index("explode(sequence")
    assert text.index("HashAggregate", repeated) < scan  # the tree is printed from its root: what is repeated has been summed up


def test_trimmed_mean_sums_weights_once(spark):
    """The weights of a group are summed up before its entries are gone through, not again for each entry: that grew with the square of a group."""
    groups = [[(float(i * 7919 % 1009), i % 11 + 1) for i in range(n)] for n in (0, 1, 9, 400)]
    rows = spark.createDataFrame([(i, g, share) for i, g in enumerate(groups) for share in (0.0, 0.1)], "i int, g array<struct<value:double,weight:bigint>>, share double")
    out = rows.select("i", "share", S.trimmed_mean(F.col("g"), F.col("share")).alias("mean"))
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("aggregate(") == 3  # the weights for the total and for the cut, and the values
    for r in out.collect():
        values = sorted(v for v, w in groups[r.i] for _ in range(w))
        cut = int(len(values) * r.share)
        kept = values[cut : len(values) - cut]
        assert (r.mean is None) if not kept else abs(r.mean - sum(kept) / len(kept)) < 1e-9


def test_line_values_are_those_of_the_repeated_sales(spark):
    """Items of one line and year are valued once for each desirability; what they are without a make or a list price is kept."""
    odd = F.col("item_id")
    items = M.items(spark, SF).withColumns({"make": F.when(odd % 9 > 0, F.col("make")), "year": F.when(odd % 11 > 0, F.lit(1980) + odd % 4), "model_key": F.when(odd % 5 > 0, "line"), "msrp": F.when(odd % 4 > 0, F.col("msrp") * (1 + odd % 3 * 30))})
    sales = M.sales(spark, SF).withColumn("mileage", F.when(F.col("lot") % 3 > 0, F.col("mileage")))
    counts = M.listing_counts(spark, SF)
    plain = V.valuations(V.window_scope(sales, items), items, counts, M.as_of())
    named = ["item_id", "make", "model", "msrp", "sales_count", "n", "n_listings", "desirability", "current_value", "signal", "timing", "segment", "forecast_5y", "liquidity", F.round("confidence", 6).alias("confidence"), F.round("annual_return", 6).alias("annual_return")]
    got = V.window_valuations(sales, items, counts, M.as_of())
    assert set(got.columns) == set(plain.columns)
    want = sorted(map(str, plain.select(*named).collect()))
    assert sorted(map(str, got.select(*named).collect())) == want and len(want) > 100


def test_ingestion_parses_and_resolves_once(spark):
    """Sales, queue and dropped rest on tables that are written on the way: none of them parses or resolves again."""
    records = audit_queries.made_up_records(spark, SF).filter("ordinal % 40 = 0")
    rates = spark.createDataFrame([(datetime.date(1998, 3, 2), "USD", 1.1)], "rate_date date, currency string, per_eur double")
    out = ingest.ingested(records, 2003, spark.createDataFrame([("Porsche", "911", "s0")], "make string, model_key string, source string"), rates)
    assert not any("InPandas" in plan(df) for df in out.values())
    lots = records.select("lot").distinct().count()
    assert lots and sum(df.count() for df in out.values()) == lots  # no lot is lost, none counted twice


def test_beaten_sales_are_those_that_pairs_drop(spark):
    """Who is beaten is told by classes of like sales: the same ids as by pairs, in one shuffle by item and one of the ids."""
    r = random.Random(5)
    some = lambda *xs: r.choice(xs)
    rows = [
        sale(some("bat", "mecum", "hagerty", "classic", "zzz", None), str(i), 1, item=some(None, *range(6)), sale_id=f"{some(*'abc')}{r.randrange(500)}", url=some(None, None, "https://x/1"), title=some(None, "T", "1990 Porsche 911", "1990 Porsche 911 Targa"), price_usd=some(None, 0.0, 100.0, 100.4, 101.5, 112.0), sold_at=some(None, *(datetime.datetime(2024, 3, d) for d in range(1, 29))), vin_normal=some(*[None] * 6, "V1", "V2"), mileage=some(None, 1000.0, 1100.0, 20200.0, 20203.0))
        for i in range(600)
    ]
    sales = spark.createDataFrame([*rows, *rows[:40]], SALE)
    found = dedup.beaten(sales)
    assert exchanges(found) == 2
    want = sorted({x.dropped for x in dedup.survivors(dedup.scored_pairs(sales)).collect()})
    assert sorted(x.id for x in found.collect()) == want and len(want) > 100
    copies = spark.range(3000).selectExpr("1 as item_id", "printf('%05d', id) as sale_id", "'bat' as source", "null as url", "'T' as title", "5.0 as price_usd", "timestamp'2024-01-01' as sold_at", "'V1' as vin_normal", "1.0 as mileage")
    assert sorted(x.id for x in dedup.beaten(copies).collect()) == [f"{i:05d}" for i in range(1, 3000)]


def test_histories_are_the_replay_of_each_record(spark):
    """An identity is looked at again only after its block has changed; every record is told what a replay of all tells it."""
    r = random.Random(3)
    some = lambda *xs: r.choice(xs)
    rows = [(i, 1990 + i % 2, some("Foo", "Foo", "foo", "Bar"), some("911", "911 turbo", "m3", "280sl xyz pagoda", "280sl pagoda qrs"), some(None, "Coupe", "Targa"), some(None, "E36"), some(None, None, "Singer"), some(None, "3.0L")) for i in range(2000)]
    schema = "ordinal long, year int, make string, model_key string, body string, generation string, modification string, displacement string"
    got = {x.ordinal: x for x in resolve.resolve(spark.createDataFrame(rows, schema)).collect()}
    blocks, names = {}, [c.split()[0] for c in schema.split(", ")]
    for row in (dict(zip(names, x)) for x in rows):
        row["make"] = row["make"].replace("foo", "Foo")
        items = blocks.setdefault((row["year"], row["make"]), resolve._Items())
        item, decision, candidate, learned = items.place(row)
        if decision == "created":
            item = items.add(row | {"item_id": resolve.item_key(row)})
        x = got[row["ordinal"]]
        assert (x.item_id, x.decision, x.candidate_id, x.learned) == (item and item["item_id"], decision, candidate and candidate["item_id"], ",".join(learned))
    assert len(got) == len(rows) and {x.decision for x in got.values()} == {"created", "attached", "ambiguous"}


def test_titles_are_judged_once(spark, monkeypatch):
    """What a title tells is found for each distinct title, not for each of its records, and records say the same as one by one."""
    day = datetime.datetime(1998, 3, 2)
    titles = ["1990 Porsche 911 Carrera", "1991 BMW M3 E36", "Neon sign for 1990 Porsche", "Sign in | 1990 Porsche 911", "no year", None]
    rows = [(i, titles[i % 6], None, "s", str(i), day, 5.0 + i if i % 7 else None, "USD", 1.0, None, None, False) for i in range(120)]
    records = spark.createDataFrame(rows, "ordinal long, title string, url string, source string, lot string, sold_at timestamp, price double, currency string, mileage double, vin string, status string, reserve_not_met boolean")
    seen, parsed_titles = [], resolve.parsed_titles
    monkeypatch.setattr(resolve, "parsed_titles", lambda df, *a, **k: seen.append(df.count()) or parsed_titles(df, *a, **k))
    rates = spark.createDataFrame([(datetime.date(1998, 3, 2), "USD", 1.1)], "rate_date date, currency string, per_eur double")
    out = ingest.ingested(records, 2003, spark.createDataFrame([("Porsche", "911", "s0")], "make string, model_key string, source string"), rates)
    assert seen == [4]  # two of six titles are told without reading them
    priced = [r[1] for r in rows if r[6] is not None]
    queue = out["queue"].collect()
    assert sorted(q.status for q in queue) == sorted(["rejected"] * priced.count(titles[2]) + [q.status for q in queue if not q.reason.startswith("standing:")])
    assert sum(q.title == "no year" for q in queue) == priced.count("no year") and sum(q.title is None for q in queue) == priced.count(None)
    assert out["sales"].count() + out["dropped"].count() == priced.count(titles[0]) + priced.count(titles[1])
