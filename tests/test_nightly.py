import json

from pyspark.sql import functions as F

from pricewright.operators import publish
from pricewright.plans import market as M
from pricewright.plans import nightly as N
from tests.conftest import SF


def test_stages_block_skip_and_fail():
    def fail():
        raise ValueError("no")

    ok = lambda: None
    stages = [N.Stage("a", ok), N.Stage("b", fail, required=False), N.Stage("c", ok), N.Stage("d", fail), N.Stage("e", ok)]
    assert [x["outcome"] for x in N.run_stages(stages)] == ["ok", "failed", "ok", "failed", "blocked"]
    assert [x["outcome"] for x in N.run_stages(stages, only=["a", "e"], skip=["e"])] == ["ok", "skipped", "skipped", "skipped", "skipped"]
    assert [x["outcome"] for x in N.run_stages(stages, deadline_s=-1)] == ["blocked"] * 5


def test_nightly_runs_twice_and_settles(spark, tmp_path):
    args = (M.sales(spark, SF), M.items(spark, SF), M.listings(spark, SF), M.as_of(), str(tmp_path))
    assert [x["outcome"] for x in N.nightly(spark, *args, 0)] == ["ok"]
    assert [x["outcome"] for x in N.nightly(spark, *args, 1)] == ["ok", "ok"]
    drift = spark.read.parquet(f"{tmp_path}/changes/version=1")
    a, b = (spark.read.parquet(f"{tmp_path}/valuations/version={i}").select("item_id", "current_value", "signal", F.round("confidence", 9).alias("c")) for i in (0, 1))
    assert a.exceptAll(b).count() == 0 and drift.columns == spark.read.parquet(f"{tmp_path}/valuations/version=1").columns
    history = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/history").collect()]
    assert sorted((h["version"], h["stage"]) for h in history) == [(0, "compute"), (1, "compute"), (1, "publish")]


def test_export_reset_and_change_set(spark, tmp_path):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "item_id long, name string")
    old = spark.createDataFrame([(1, "a"), (2, "x"), (9, "z")], "item_id long, name string")
    publish.exported({"item": items, "queue": items, "log": items}, str(tmp_path), empty=["queue"], leave_out=["log"])
    assert spark.read.parquet(f"{tmp_path}/item.parquet").count() == 3 and spark.read.parquet(f"{tmp_path}/queue.parquet").count() == 0 and not (tmp_path / "log.parquet").exists()
    upsert, delete = publish.change_set({"item": items}, {"item": old}, {"item": ["item_id"]})["item"]
    assert sorted(r.item_id for r in upsert.collect()) == [2, 3] and [r.item_id for r in delete.collect()] == [9]
    assert [r.item_id for r in publish.reset(items, spark.createDataFrame([(2,), (2,)], "item_id long")).collect()] == [2]


def test_casing_merge(spark):
    schema = "item_id long, year int, make string, model_key string, body string, generation string, modification string, displacement string"
    items = spark.createDataFrame([(1, 1990, "Saab", "900", None, None, None, None), (2, 1990, "SAAB", "900", "", None, None, None), (3, 1991, "SAAB", "900", None, None, None, None)], schema)
    sales = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (3, 13), (3, 14), (3, 15)], "item_id long, sale int")
    mapping = publish.renamed_makes(items, sales)
    assert [(r.item_id, r.survivor_id) for r in mapping.collect()] == [(1, 2)]
    assert sorted((r.sale, r.item_id) for r in publish.repointed(sales, mapping).collect()) == [(10, 2), (11, 2), (12, 2), (13, 3), (14, 3), (15, 3)]
    assert publish.repointed(sales, mapping).columns == sales.columns
