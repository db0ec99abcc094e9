"""Publishing and merging tables: change sets between versions, upserts that keep what is known."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_keys(new: DataFrame, old: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Keys of ``new`` with a row that ``old`` has not, bookkeeping columns aside. Two 64-bit hashes stand for a row's other columns."""
    judged = [c for c in new.columns if c not in ignore and c not in key]

    def told(df: DataFrame) -> DataFrame:
        # hashes pass over nulls, so it is hashed too which columns have one
        blank = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in judged])
        return df.select(*key, F.xxhash64(blank, *judged).alias("h1_"), F.xxhash64(F.lit(7), blank, *judged).alias("h2_"))

    return told(new).subtract(told(old)).select(*key).distinct()


def changed_rows(new: DataFrame, old: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Whole rows of ``new`` that ``old`` has not, bookkeeping columns aside; equal rows count once."""
    judged = [c for c in new.columns if c not in ignore]
    keys = new.select(*judged).subtract(old.select(*judged)).select(*key).distinct()
    return new.join(keys, list(key), "left_semi")


def deleted_keys(new: DataFrame, old: DataFrame, key: Sequence[str]) -> DataFrame:
    return old.select(*key).subtract(new.select(*key))


def merged(old: DataFrame, new: DataFrame, key: Sequence[str], overwrite: Sequence[str], fill: Sequence[str], only_if=None) -> DataFrame:
    """``old`` with the rows of ``new``: ``overwrite`` takes the new value, ``fill`` the new one if it has one, others stay.

    ``only_if(o)``: condition on the old row (columns prefixed o_) under which it may change. Rows
    of ``new`` with an unknown key are added whole. ``new`` has one row for each key.
    """
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in old.columns], F.lit(True).alias("o_there"))
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in new.columns], F.lit(True).alias("n_there"))
    on = [F.col(f"o_{k}") == F.col(f"n_{k}") for k in key]
    joined = o.join(n, on, "full")
    fresh = F.col("o_there").isNull()
    may = F.col("n_there").isNotNull() & (F.lit(True) if only_if is None else F.coalesce(only_if(lambda c: F.col(f"o_{c}")), F.lit(False)))
    columns = []
    for c in old.columns:
        was, now = F.col(f"o_{c}"), F.col(f"n_{c}") if c in new.columns else F.lit(None)
        x = now if c in overwrite else F.coalesce(now, was) if c in fill else was
        columns.append(F.when(fresh, now).when(may, x).otherwise(was).alias(c))
    return joined.select(*columns)


#: A resolved entry is final; others may be replaced by any.
QUEUE_RANK = {"resolved": 2, "pending": 1, "rejected": 1, "duplicate": 1}


def queue_upsert(queue: DataFrame, entries: DataFrame) -> DataFrame:
    """Review queue with new entries: nothing resolved changes, ``created_at`` is kept."""
    changing = [c for c in entries.columns if c not in ("source", "lot", "created_at")]
    return merged(queue, entries, ["source", "lot"], changing, [], lambda o: o("status") != "resolved")


def exported(tables: dict[str, DataFrame], path: str, empty: Sequence[str] = (), leave_out: Sequence[str] = ()) -> None:
    """Write the tables that are served, some as schemas only, each compacted to few files by Spark's own sizing."""
    for name, df in tables.items():
        if name not in leave_out:
            (df.limit(0) if name in empty else df).hint("rebalance").write.mode("overwrite").parquet(f"{path}/{name}.parquet")


def change_set(new: dict[str, DataFrame], old: dict[str, DataFrame], keys: dict[str, Sequence[str]], ignore: Sequence[str] = ()) -> dict[str, tuple[DataFrame, DataFrame]]:
    """For each table, parents before children as ``keys`` lists them: rows to upsert, and keys to delete (in reverse order)."""
    return {name: (changed_rows(new[name], old[name], key, [c for c in ignore if c in new[name].columns]), deleted_keys(new[name], old[name], key)) for name, key in keys.items()}


def reset(items: DataFrame, referenced: DataFrame) -> DataFrame:
    """Items that a full reset keeps: those that a holding refers to."""
    return items.join(referenced.select("item_id").distinct(), "item_id", "left_semi")


def renamed_makes(items: DataFrame, sales: DataFrame) -> DataFrame:
    """(item_id, survivor_id): items equal but for the case of their make fall to the spelling with most sales.

    Blanks equal blanks here: the identity is compared as a whole.
    """
    identity = ["year", "model_key", "body", "generation", "modification", "displacement"]
    counts = sales.groupBy("item_id").agg(F.count("*").alias("n"))
    spelled = items.join(counts, "item_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    totals = spelled.groupBy("make").agg(F.sum("n").alias("make_n"))
    ranked = spelled.join(totals, "make").withColumn("key", F.concat_ws("~", F.lower("make"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity]))
    best = ranked.groupBy("key").agg(F.max_by("item_id", F.struct("make_n", "make", "n", "item_id")).alias("survivor_id"))
    return ranked.join(best, "key").filter("item_id <> survivor_id").select("item_id", "survivor_id")


def repointed(children: DataFrame, mapping: DataFrame) -> DataFrame:
    """Children of merged items under the survivors."""
    return children.join(mapping, "item_id", "left").withColumn("item_id", F.coalesce("survivor_id", "item_id")).drop("survivor_id").select(*children.columns)


def append_history(spark, path: str, entry: dict) -> None:
    """Add one run to the history, a folder of JSON lines."""
    import json

    spark.createDataFrame([(json.dumps(entry, sort_keys=True),)], "value string").coalesce(1).write.mode("append").text(path)
