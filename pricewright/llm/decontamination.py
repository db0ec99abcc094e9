"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame operations only.

A bottom-k MinHash of an item's shingles finds the documents that contain the item, however long
they are: if a document holds the share ``t`` of an item's ``q`` shingles, at most ``q - ceil(t q)``
of them are missing, so one of the item's ``q - ceil(t q) + 1`` least-hashed shingles occurs in it.
Items are partitioned by size, and each size class has the k that loses none of its items; no share
of long documents is lost, as with signatures of one length for both sides.

The sketches of the items are the index: the shingles of all documents meet only those. Each text that
has a sketch shingle of an item is a candidate for it, and candidates alone are verified, by
intersecting the whole sets of shingles of text and item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, columns, private, read, small, text_keys, written


def shingles(text: Column, words: int, also: tuple[int, ...] = ()) -> Column:
    """Array of distinct shingle hashes; words are runs of letters and digits, lower-cased.

    A text of fewer words gives its whole sequence as one shingle, a text without words none. ``also``:
    shorter lengths whose shingles are added; a hash tells shingles of different lengths apart.
    """
    found = word_list(text)
    hashed = F.transform(found, lambda w: F.xxhash64(w))

    def runs(h: Column, n: int) -> Column:
        # the hash of fewer words has nulls for those it lacks
        lacks = [F.lit(None).cast("long")] * (words - n)
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - n, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)], *lacks, F.least(F.size(h), F.lit(n))))

    def windows(h: Column) -> Column:
        return F.concat(runs(h, words), *[runs(h, n) for n in also]) if also else runs(h, words)

    # the array is named once, so that it is not computed again for each use
    named = F.transform(F.array(hashed), windows)
    return F.when(F.size(found) > 0, F.array_distinct(F.element_at(named, 1))).otherwise(F.array().cast("array<bigint>"))


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def sketches(items: DataFrame, percent: int = 80) -> DataFrame:
    """(i1, i2, h): the least hashes of each set ``s`` of ``items``, as many as its size class needs to lose none of it."""
    size = F.size("s")
    # the size class bounds q from above; its k covers the largest item in it, so it covers all
    size_class = F.pow(F.lit(2), F.ceil(F.log2(size))).cast("int")
    k = F.least(size, size_class - F.ceil(size_class * percent / 100) + 1).cast("int")
    return items.select("i1", "i2", F.explode(F.slice(F.sort_array("s"), 1, k)).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80, doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(k1, k2, item_id, n_shared, n_item, containment) of every text that holds ``percent`` of an item's shingles.

    ``k1, k2`` name a text (``common.text_keys``), so copies are told once and rows may repeat. Very
    long texts are read whole. An item of fewer than ``words`` words is one shingle, found wherever a
    text has those words in a row. Null and blank texts and items match nothing, nor does anything if a
    table is empty; items with equal texts are verified once and each reported; a null item_id is
    reported as null. Other columns of either table are not looked at.
    """
    named = items.select(F.col(f"`{item_id}`").alias("item_id"), shingles(F.col(f"`{item_text}`"), words).alias("s")).filter(F.size("s") > 0).withColumn("s", F.sort_array("s"))
    named = named.withColumns({"i1": F.xxhash64("s"), "i2": F.xxhash64(F.lit(7), "s")})
    sets = named.select("i1", "i2", "s").dropDuplicates(["i1", "i2"])
    k1, k2 = text_keys(F.col(f"`{doc_text}`"))
    # shorter shingles only of lengths that some item has
    lengths = items.select(F.size(word_list(F.col(f"`{item_text}`"))).alias("n")).filter(f"n between 1 and {words - 1}").distinct()
    also = tuple(sorted(r.n for r in lengths.collect()))
    with Scratch(docs.sparkSession) as scratch:
        met = docs.select(k1.alias("k1"), k2.alias("k2"), F.explode(shingles(F.col(f"`{doc_text}`"), words, also)).alias("h")).join(small(sketches(sets, percent)), "h")
        candidates = scratch.written(met.select("k1", "k2", "i1", "i2").distinct(), "candidates")
        texts = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(f"`{doc_text}`").alias("text")).join(small(candidates.select("k1", "k2").distinct()), ["k1", "k2"], "left_semi")
        own = texts.select("k1", "k2", shingles(F.col("text"), words, also).alias("t"))
        both = own.join(small(candidates), ["k1", "k2"]).join(small(sets), ["i1", "i2"])
        counted = both.select("k1", "k2", "i1", "i2", F.size(F.array_intersect("t", "s")).cast("long").alias("n_shared"), F.size("s").cast("long").alias("n_item"))
        # copies of a text give the same row
        kept = counted.filter(f"100 * n_shared >= {percent} * n_item").distinct()
        return written(kept.join(small(named.select("i1", "i2", "item_id").distinct()), ["i1", "i2"]).select("k1", "k2", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment")), "contaminated")


def decontaminated(docs: DataFrame, items: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose text holds no item; columns as they are, whatever their names; null texts stay."""
    bad = contaminated(docs, items, words, percent).select("k1", "k2").distinct()
    k1, k2 = private(docs, "k1", "k2")
    h1, h2 = text_keys(F.col("text"))
    return docs.withColumns({k1: h1, k2: h2}).join(bad.withColumnsRenamed({"k1": k1, "k2": k2}), [k1, k2], "left_anti").select(*columns(docs))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): every document that holds 80 % of an item."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated(docs, read(spark, sf_dir, "benchmark"))
    k1, k2 = text_keys(F.col("text"))
    return docs.select("doc_id", k1.alias("k1"), k2.alias("k2")).join(found, ["k1", "k2"]).select("doc_id", "item_id", "n_shared", "n_item", "containment")


OP7_SQL = r"""
with w as (
  select 'd' as side, doc_id as id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents
  union all
  select 'i', item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') from benchmark
), s as (
  select distinct side, id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as h from w
  union
  select side, id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) from w, (select distinct len(w) as n from w where side = 'i' and len(w) between 1 and 4)
  where side = 'd' and len(w) > n
), i as (select id as item_id, h, count(*) over (partition by id) as n_item from s where side = 'i'),
m as (select d.id as doc_id, i.item_id, i.n_item, count(*) as n_shared from s d join i on d.h = i.h where d.side = 'd' group by all)
select doc_id, item_id, n_shared, n_item, n_shared / n_item as containment from m where 100 * n_shared >= 80 * n_item
"""
