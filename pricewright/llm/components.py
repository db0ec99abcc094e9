"""Connected components of an edge table, by hooking and pointer jumping; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Rows of one file of the tables between rounds.
FILE_ROWS = 100_000


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): root is the least node that it reaches.

    Each round hooks every root to its least neighbouring root and contracts the graph, so rounds
    grow with the logarithm of the longest path. Only distinct pairs of different roots stay. Tables
    between rounds have files in proportion to the edges left.
    """
    spark = edges.sparkSession
    live = scratch.written(edges.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "edges")
    roots, most = None, 1
    while left := live.count():
        files = 1 + left // FILE_ROWS
        most = max(most, files)

        def written(df: DataFrame, name: str, files: int = files) -> DataFrame:
            return scratch.written(df.coalesce(files), name)

        parent = written(live.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), "parents")
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = written(parent.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "parents")
            parent = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        lo, hi = (parent.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("lo", "hi"))
        x, y = F.coalesce("lo_root", "lo"), F.coalesce("hi_root", "hi")
        live = written(live.join(lo, "lo", "left").join(hi, "hi", "left").select(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi")).filter("lo <> hi").distinct(), "edges")
        if roots is None:
            roots = parent
        else:
            onward = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
            moved = roots.join(onward, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
            roots = written(moved.unionByName(parent).groupBy("node").agg(F.min("root").alias("root")), "roots", most)
    if roots is None:
        return spark.createDataFrame([], "node long, root long")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct().coalesce(most)
