"""Packing into optimal length buckets.

A dynamic program over the global histogram of lengths chooses the bucket boundaries (the lengths
to which sequences are padded) that waste the fewest tokens; within a bucket sequences fill batches
of a token budget. The histogram has one row for each length up to the context length, whatever
the corpus; positions within a bucket come from counts per (bucket, shard), so no task sorts or
numbers a whole bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, read, written

ADDED = ("piece", "n_pieces", "n_tokens", "bucket", "padded_length", "batch", "slot")


def optimal_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """At most ``buckets`` boundaries, each a length that occurs, of least total padding.

    ``cost(j, k) = min over i < j of cost(i, k - 1) + len_j (C_j - C_i) - (T_j - T_i)`` with C, T the
    running counts and token sums: the lower envelope of lines with slopes -C_i, in one sweep per
    bucket. Of equal costs the fewest buckets win, then the earliest split.
    """
    lengths = sorted(x for x, n in histogram.items() if n > 0)
    if not lengths:
        return []
    c = [0, *np.cumsum([histogram[x] for x in lengths], dtype=object).tolist()]
    t = [0, *np.cumsum([histogram[x] * x for x in lengths], dtype=object).tolist()]
    m = len(lengths)
    best = [0] + [None] * m
    splits: list[list[int]] = []
    final = None
    for k in range(min(buckets, m)):
        now: list[int | None] = [None] * (m + 1)
        back = [0] * (m + 1)
        hull: list[tuple[int, int, int]] = []  # slope, intercept, i
        at = 0
        for j in range(1, m + 1):
            i = j - 1
            if best[i] is not None:
                line = (-c[i], best[i] + t[i], i)
                while len(hull) >= 2 and _useless(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            if not hull:
                continue
            x = lengths[j - 1]
            at = min(at, len(hull) - 1)
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            slope, intercept, i = hull[at]
            now[j], back[j] = slope * x + intercept + x * c[j] - t[j], i
        splits.append(back)
        if final is None or now[m] < final[0]:
            final = (now[m], k)
        best = now
    bounds, j = [], m
    for back in reversed(splits[: final[1] + 1]):
        bounds.append(lengths[j - 1])
        j = back[j]
    return bounds[::-1]


def _useless(a: tuple, b: tuple, c: tuple) -> bool:
    """Whether line b is nowhere strictly below both a and c (slopes fall from a to c)."""
    if b[0] == c[0]:
        return c[1] <= b[1]
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def word_count(text: Column) -> Column:
    """Number of words (runs of anything but ASCII white space); 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def pack(docs: DataFrame, key: str = "doc_id", length: Column | None = None, context: int = 2048, buckets: int = 8, budget: int = 65_536, shards: int = 64) -> DataFrame:
    """One row for each piece of each row of ``docs``: key and the columns ADDED.

    ``length``: tokens of a row (words of ``text`` if not given). A row of more than ``context`` tokens
    is cut into pieces of ``context`` and a rest; one of none has a single piece of 0 tokens in a
    bucket of its own length class. ``padded_length`` is the bucket's boundary; ``batch`` numbers the
    batches of a bucket from 0, each holding floor(budget / padded_length) pieces (1 at least) but
    for the last one; ``slot`` is the place in the batch. Null keys and repeated rows are packed
    like others; equal keys keep no order among them. Very long texts are counted whole. An empty table
    gives an empty one; no column of ``docs`` but the key and those of ``length`` is looked at.
    """
    spark = docs.sparkSession
    if budget < context:
        raise ValueError("the token budget must hold one sequence of the context length")
    n = F.coalesce(length if length is not None else word_count(F.col("text")), F.lit(0)).cast("long")
    sized = written(docs.select(F.col(key), F.greatest(n, F.lit(0).cast("long")).alias("total"), F.pmod(F.xxhash64(F.col(key), n), F.lit(shards)).cast("int").alias("shard")), "sized")
    pieces = F.greatest(F.ceil(F.col("total") / context), F.lit(1)).cast("int")
    cut = sized.withColumn("n_pieces", pieces).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1))).withColumn("n_tokens", F.least(F.col("total") - F.col("piece") * F.lit(context), F.lit(context)).cast("long"))
    # at most context + 1 rows
    counts = {r.n_tokens: r.n for r in cut.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    bounds = optimal_boundaries(counts, buckets)
    if not bounds:
        return cut.select(key, "piece", "n_pieces", "n_tokens", F.lit(0).alias("bucket"), F.lit(0).cast("long").alias("padded_length"), F.lit(0).cast("long").alias("batch"), F.lit(0).alias("slot"))
    bucket = F.lit(len(bounds) - 1)
    for i, b in reversed(list(enumerate(bounds[:-1]))):
        bucket = F.when(F.col("n_tokens") <= b, i).otherwise(bucket)
    placed = cut.withColumn("bucket", bucket).withColumn("padded_length", F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("bucket") + 1))
    # where each (bucket, shard) begins: len(bounds) * shards rows
    per_shard = placed.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    before = per_shard.withColumn("begin", F.sum("n").over(Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
    own = Window.partitionBy("bucket", "shard").orderBy(F.col(key), "piece", "n_tokens", "n_pieces")
    rank = F.row_number().over(own) - 1
    numbered = placed.withColumn("rank", rank).join(F.broadcast(before.select("bucket", "shard", F.coalesce("begin", F.lit(0)).alias("begin"))), ["bucket", "shard"])
    at, room = F.col("begin") + F.col("rank"), F.greatest(F.floor(F.lit(budget) / F.greatest(F.col("padded_length"), F.lit(1))), F.lit(1)).cast("long")
    return numbered.select(key, "piece", "n_pieces", "n_tokens", "bucket", "padded_length", F.floor(at / room).cast("long").alias("batch"), F.pmod(at, room).cast("int").alias("slot"))


def shards_for(spark: SparkSession) -> int:
    """Enough shards that the largest bucket spreads over every task."""
    return max(256, 2 * partitions(spark))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in length buckets of a 2048-word context and batches of 65,536."""
    return pack(read(spark, sf_dir, "documents"), shards=shards_for(spark))
