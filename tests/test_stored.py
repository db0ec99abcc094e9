import datetime

import duckdb
from pyspark.sql import functions as F

from pricewright.operators import dedup, garage, quality, stored
from pricewright.plans import catalogue
from tests.conftest import SF

SALE = "item_id int, sale_id string, source string, lot string, url string, title string, price double, price_usd double, currency string, sold_at timestamp, status string, vin string, vin_normal string, mileage double, transmission string"


def sale(source, lot, day, price=50_000.0, vin="WDB1234567", item=1, **more):
    row = {"item_id": item, "sale_id": f"{source}::{lot}", "source": source, "lot": lot, "url": f"https://{source}/{lot}", "title": "T", "price": price, "price_usd": price, "currency": "USD", "sold_at": datetime.datetime(2024, 3, day), "status": "sold", "vin": vin, "vin_normal": vin, "mileage": 1000.0, "transmission": None} | more
    return tuple(row[c.split()[0]] for c in SALE.split(", "))


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_a_batch_meets_the_store(spark):
    old = spark.createDataFrame([sale("hagerty", "1", 1), sale("bat", "2", 1, vin="WDB7654321"), sale("classic", "3", 1, vin="WDB5555555", item=2)], SALE)
    new = spark.createDataFrame(
        [
            sale("bat", "10", 2),  # more trusted than what is stored
            sale("elsewhere", "11", 2, vin="WDB7654321"),  # less trusted: dropped
            sale("mecum", "12", 3, vin="WDB9999999"),  # another car
            sale("elsewhere", "13", 20, vin="WDB7654321"),  # not within a week
            sale("bat", "2", 1, vin="WDB7654321", price=60_000.0, mileage=None),  # known: refreshed
            sale("classic", "14", 2, vin="WDB5555555", item=2),  # as trusted: the stored one stays
            sale("elsewhere", "15", 2, vin="WDB8888888"),
            sale("bat", "16", 3, vin="WDB8888888"),  # within the batch the more trusted one stays
        ],
        SALE,
    )
    out = stored.taken_in(old, new)
    assert ids(out["replaced"]) == ["hagerty::1"]
    assert ids(out["dropped"]) == ["classic::14", "elsewhere::11", "elsewhere::15"]
    sales = {r.sale_id: r for r in out["sales"].collect()}
    assert sorted(sales) == ["bat::10", "bat::16", "bat::2", "classic::3", "elsewhere::13", "mecum::12"]
    assert (sales["bat::2"].price, sales["bat::2"].mileage) == (60_000.0, 1000.0)
    again = stored.taken_in(out["sales"], new)
    assert sorted(map(tuple, again["sales"].collect())) == sorted(map(tuple, out["sales"].collect())) and again["replaced"].count() == 0


def test_rows_that_share_an_id_are_all_kept(spark):
    """Of rows that share an id the batch brings each once, however often it is taken in; an id that goes takes one of them."""
    old = spark.createDataFrame([sale("bat", "1", 1, item=1), sale("classic", "2", 1, item=2), sale("classic", "2", 1, item=3)], SALE)
    new = spark.createDataFrame(
        [
            sale("mecum", "10", 1, item=4),
            sale("mecum", "10", 1, item=5),  # the same id, another item
            sale("hagerty", "11", 2, item=6),
            sale("hagerty", "11", 2, item=6),  # the same row twice
            sale("mecum", "12", 2, item=2),  # replaces one of two that share an id
            sale("elsewhere", "13", 2, item=1),  # dropped
            sale("elsewhere", "13", 2, item=7),
        ],
        SALE,
    )
    old, new = (dedup.numbered(df, ["sale_id"], "item_id") for df in (old, new))
    out = stored.taken_in(old, new, copy="copy")
    rows = sorted((r.sale_id, r.item_id) for r in out["sales"].collect())
    assert rows == [("bat::1", 1), ("classic::2", 3), ("elsewhere::13", 7), ("hagerty::11", 6), ("hagerty::11", 6), ("mecum::10", 4), ("mecum::10", 5), ("mecum::12", 2)]
    again = stored.taken_in(out["sales"], new, copy="copy")
    assert sorted(map(tuple, again["sales"].collect())) == sorted(map(tuple, out["sales"].collect()))


def test_ingest_twice_with_shared_ids_is_its_sql(spark, tmp_path):
    """Lines of one order, number and price, as they come about in large tables, are counted as SQL counts them."""
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in ("part", "orders", "customer", "supplier", "nation", "region"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    line = f"'{SF}/lineitem.parquet'"
    c.execute(f"copy (select * from {line} union all by name select * replace ((l_partkey * 7 + 3) % 200 as l_partkey) from {line} where l_orderkey % 10 < 2 union all by name select * from {line} where l_orderkey % 10 = 5) to '{tmp_path}/lineitem.parquet' (format parquet)")
    for f in tmp_path.glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    found = c.execute(catalogue.ORACLES["ingest_twice"])
    want = dict(zip([x[0] for x in found.description], found.fetchone()))
    assert catalogue.QUERIES["ingest_twice"](spark, str(tmp_path)).first().asDict() == want


def test_a_dropped_sale_replaces_nothing(spark):
    """A sale that a more trusted stored one beats leaves a less trusted stored one alone; levels are taken best first."""
    pairs = spark.createDataFrame([(1, "a", "good", 2, 1), (1, "a", "poor", 2, 9), (2, "best", "mid", 1, 2), (2, "late", "mid", 5, 2)], "item_id int, a_id string, b_id string, a_trust int, b_trust int")
    got = sorted(map(tuple, stored.settled(pairs).collect()))
    assert got == [("a", "dropped"), ("mid", "replaced")]  # `late` stays: what would have beaten it is gone
    assert stored.settled(pairs.limit(0)).count() == 0


def test_natural_keys(spark):
    rows = spark.createDataFrame([("bat", "1"), (None, "1"), ("bat", " ")], "source string, lot string")
    got = [(r.sale_id, r.key_error) for r in stored.natural_key(rows).collect()]
    assert got[0] == ("bat::1", None) and [e for _, e in got[1:]] == ["source missing", "lot missing"]


def test_listing_states(spark):
    schema = "source string, lot string, price double, url string, value_type string, estimate_low double, is_active boolean"
    at = F.lit("2024-01-01").cast("timestamp")
    got = {r.lot: r for r in stored.listing_state(spark.createDataFrame([("s", "1", 5.0, None, "Asking", None, None), ("s", "2", 5.0, None, None, 4.0, None), ("s", "3", 5.0, None, None, None, True)], schema), at).collect()}
    assert [(got[k].is_active, got[k].listing_type, got[k].listing_status, got[k].price_type) for k in "123"] == [(True, "classified", "live", "asking"), (False, "auction", "unknown", "estimate"), (True, "classified", "live", "asking")]
    assert got["1"].currency == "USD" and got["1"].first_seen_at == got["1"].last_seen_at


def test_queue_rows_and_classes(spark):
    queue = spark.createDataFrame([("s", "1", "pending", None, '{"title": "x", "sold_at": null}'), ("s", "2", "rejected", None, '{"title": "x"}'), ("s", "3", "pending", "sale", '{"a": 1}'), ("s", "4", "pending", None, "{"), ("s", "5", "resolved", None, "{}"), ("s", "6", "pending", None, "null"), ("s", "7", "pending", None, None)], "source string, lot string, status string, kind string, raw_record string")
    assert {r.lot: r.kind for r in stored.replayable(queue).collect()} == {"1": "sale", "2": "listing", "3": "sale"}
    after = stored.cleared(queue, spark.createDataFrame([("s", "1"), ("s", "5")], "source string, lot string"))
    assert {r.lot: r.status for r in after.collect()}["1"] == "resolved"
    assert {r.status: r.change for r in stored.counts_between(queue, after, "status").collect()} == {"pending": -1, "rejected": 0, "resolved": 1}
    rows = spark.createDataFrame([(True, False, "c"), (True, True, None), (False, False, None), (True, False, None)], "ok boolean, inferred boolean, candidate string")
    assert [r.x for r in rows.select(stored.decision_class(F.col("ok"), F.col("inferred"), F.col("candidate")).alias("x")).collect()] == ["SAME_CAR?", "UNKNOWN_MAKE", "UNPARSEABLE", "UNPROVEN_MODEL"]


def test_garage_input_and_order(spark):
    texts = spark.createDataFrame([(None,), ("",), (" a ",), ("x" * 9,)], "t string")
    value, error = garage.clean_text(F.col("t"), 5, "name")
    assert [tuple(r) for r in texts.select(value.alias("v"), error.alias("e")).collect()] == [(None, None), (None, None), ("a", None), (None, "name is too long")]
    numbers = spark.createDataFrame([("12",), ("1e3",), ("-1",), ("1.5",), ("x",), (None,)], "t string")
    value, error = garage.clean_integer(F.col("t"), "miles")
    got = [tuple(r) for r in numbers.select(value.alias("v"), error.isNull().alias("ok")).collect()]
    assert got == [(12, True), (1000, True), (None, False), (None, False), (None, False), (None, True)]
    options = spark.createDataFrame([('[" a ", "", "b"]',), ("[1]",), ("{}",), (None,), ("[]",)], "t string")
    value, error = garage.clean_options(F.col("t"))
    assert [(r.v, r.ok) for r in options.select(value.alias("v"), error.isNull().alias("ok")).collect()] == [(["a", "b"], True), (None, False), (None, False), ([], True), ([], True)]
    changes = spark.createDataFrame([(1, 1, "create", "red", 5), (1, 2, "patch", None, 7), (2, 1, "create", "blue", 1), (2, 3, "archive", None, None), (3, 3, "create", None, None)], "id int, at int, action string, color string, miles int").withColumn("tie", F.lit(0))
    got = garage.in_garage_order(garage.latest(changes, "id", "at", "tie", ["color", "miles"]), "id").collect()
    assert [(r.id, r.status, r.color, r.miles) for r in got] == [(3, "owned", None, None), (1, "owned", "red", 7), (2, "archived", "blue", 1)]


def test_baselines_and_health(spark, tmp_path):
    assert quality.baseline(spark, str(tmp_path / "none")).count() == 0
    rows = spark.createDataFrame([("s", str(i), "T", "en" if i < 4 else None, datetime.datetime(2024, 1, 1), 5.0 if i else None, None, 1.0) for i in range(8)], "source string, lot string, title string, lang string, sold_at timestamp, price double, status string, mileage double")
    now, as_of = quality.population(rows, ["lang"]), F.lit("2024-06-01").cast("timestamp")
    first = quality.health(rows.filter("price is not null"), quality.drift(now, quality.baseline(spark, str(tmp_path / "none"))), as_of).first()
    assert (first.status, first.invalid) == ("BASELINE_ESTABLISHED", 0)
    quality.saved_baseline(now.withColumn("share", F.lit(0.95)), str(tmp_path / "b"))
    then = quality.health(rows, quality.drift(now, quality.baseline(spark, str(tmp_path / "b"))), as_of).first()
    assert (then.n, then.invalid, then.drifted, then.status) == (8, 1, True, "NEEDS_REVIEW")


def test_last_harvest_wins(spark):
    runs = [spark.createDataFrame(r, "key int, x string") for r in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d"), (3, "e")])]
    assert sorted(map(tuple, stored.last_wins(runs, ["key"]).collect())) == [(1, "a"), (2, "c"), (3, "e")]
