import datetime

from pyspark.sql import functions as F

from pricewright.operators import dedup, lifecycle, publish, quality
from pricewright.operators import valuation as V
from pricewright.plans import market as M
from pricewright.streaming import lifecycle as stream
from tests.conftest import SF


def test_valuation_ignores_row_order(spark):
    sales = V.own_scope(M.sales(spark, SF).filter("item_id < 20"))
    args = (M.items(spark, SF), M.listing_counts(spark, SF), M.as_of())
    pick = lambda df: sorted((r.item_id, r.current_value, r.signal, round(r.confidence, 9)) for r in df.collect())
    assert pick(V.valuations(sales, *args)) == pick(V.valuations(sales.orderBy(F.rand(1)), *args))


def test_borrowing_keeps_the_own_price(spark):
    items, counts = M.items(spark, SF), M.listing_counts(spark, SF)
    sales = M.sales(spark, SF).filter("source_id = 1")
    own = V.valuations(V.own_scope(sales), items, counts, M.as_of())
    wide = V.valuations(V.window_scope(sales, items), items, counts, M.as_of())
    o = {r.item_id: r for r in own.collect()}
    w = {r.item_id: r for r in wide.collect()}
    seen = set()
    for r in V.best_scope(own, wide).collect():
        seen.add(r.scope)
        if r.scope == "own":
            assert r.confidence == o[r.item_id].confidence
        else:
            assert abs(r.confidence - 0.6 * w[r.item_id].confidence) < 1e-12 and r.signal == w[r.item_id].signal != "insufficient"
            assert r.current_value == (o[r.item_id].current_value if r.scope == "own-price/window-trend" else w[r.item_id].current_value)
    assert {"own", "own-price/window-trend"} <= seen


def test_greedy_collapse_follows_the_survivor(spark):
    day = lambda n: datetime.datetime(2024, 1, n)
    rows = [(1, 1, "classic", "u1", "a car", 100.0, day(1), "V" * 12 + "1", 5.0), (1, 2, "bat", "u2", "a car", 100.0, day(6), "V" * 12 + "1", 5.0), (1, 3, "mecum", "u3", "a car", 100.0, day(12), "V" * 12 + "1", 5.0), (2, 4, "bat", "u4", "b", 9.0, day(1), None, None)]
    sales = spark.createDataFrame(rows, "item_id long, sale_id long, source string, url string, title string, price_usd double, sold_at timestamp, vin_normal string, mileage double")
    pairs = dedup.scored_pairs(sales)
    assert {(r.a_id, r.b_id) for r in pairs.collect()} == {(1, 2), (2, 3)}
    assert {r.id: r.survivor_id for r in dedup.collapsed(sales, pairs).collect()} == {1: 2, 2: 2, 3: 2}
    assert {(r.survivor, r.dropped) for r in dedup.survivors(pairs).collect()} == {(2, 1), (2, 3)}


def test_merge_keeps_what_is_known(spark):
    old = spark.createDataFrame([(1, 10, "a", 1), (2, 20, None, 1)], "k int, price int, vin string, stamp int")
    new = spark.createDataFrame([(1, 11, None), (2, 21, "b"), (3, 30, "c")], "k int, price int, vin string")
    got = {r.k: (r.price, r.vin, r.stamp) for r in publish.merged(old, new, ["k"], ["price"], ["vin"]).collect()}
    assert got == {1: (11, "a", 1), 2: (21, "b", 1), 3: (30, "c", None)}
    again = publish.merged(publish.merged(old, new, ["k"], ["price"], ["vin"]), new, ["k"], ["price"], ["vin"])
    assert {r.k: (r.price, r.vin, r.stamp) for r in again.collect()} == got


def test_resolved_queue_rows_are_final(spark):
    schema = "source string, lot string, status string, created_at string"
    queue = spark.createDataFrame([("s", "1", "resolved", "old"), ("s", "2", "rejected", "old")], schema)
    entries = spark.createDataFrame([("s", "1", "pending", "new"), ("s", "2", "pending", "new"), ("s", "3", "pending", "new")], schema)
    assert sorted((r.lot, r.status, r.created_at) for r in publish.queue_upsert(queue, entries).collect()) == [("1", "resolved", "old"), ("2", "pending", "old"), ("3", "pending", "new")]


def test_record_errors(spark):
    rows = [("s", "1", "t", "2024-01-01", 5.0, 1.0, "sold"), (None, None, " ", None, None, -1.0, "reserve_not_met"), ("s", "1", "t", "2030-01-01", 0.0, None, "sold")]
    df = spark.createDataFrame(rows, "source string, lot string, title string, sold_at string, price double, mileage double, status string")
    got = [r.e for r in df.select(quality.record_errors(F.lit("2025-01-01").cast("timestamp")).alias("e")).collect()]
    assert got == [[], ["source missing", "lot id missing", "title missing", "sale date missing or invalid", "mileage negative"], ["sale date in the future", "price not positive"]]


def test_transitions(spark):
    df = spark.createDataFrame([("live", "sold"), ("ended", "sold"), ("ended", "live"), ("sold", "ended"), ("live", None)], "a string, b string")
    assert [r.x for r in df.select(lifecycle.transition(F.col("a"), F.col("b")).alias("x")).collect()] == ["sold", "sold_after", "ended", "sold", "live"]


def test_stream_merges_once_and_keeps_closed_states(spark, tmp_path):
    schema = "lot string, state string, observed_at timestamp, event_id long"
    t = lambda d: datetime.datetime(2024, 1, d)
    batches = [[("a", "live", t(1), 1), ("b", "live", t(1), 2)], [("a", "sold", t(2), 3), ("a", "sold", t(2), 3)], [("a", "live", t(3), 4), ("c", "ended", t(3), 5)]]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        q = stream.observed(spark.readStream.schema(schema).parquet(source), ["lot"]).writeStream.foreachBatch(stream.merge_batches(target, "lot")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    versions = sorted(int(p.name.split("=")[1]) for p in (tmp_path / "out").iterdir() if "=" in p.name)
    got = {r.lot: r.state for r in spark.read.parquet(f"{target}/version={versions[-1]}").collect()}
    assert got == {"a": "sold", "b": "live", "c": "ended"}


def test_daily_counts_stream(spark, tmp_path):
    schema = "lot string, state string, observed_at timestamp, event_id long"
    spark.createDataFrame([("a", "live", datetime.datetime(2024, 1, 1), 1), ("b", "live", datetime.datetime(2024, 1, 1, 5), 2)], schema).write.parquet(str(tmp_path / "in"))
    q = stream.daily_counts(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("daily").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.state, r["count"]) for r in spark.table("daily").collect()] == [("live", 2)]
