"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A broadcast side may have so many rows at most; callers count before they broadcast.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only in local mode, where all run on one machine, may it be unset; then one of our own is taken.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (path or "/tmp/checkpoints").rstrip("/")


def written(df: DataFrame, name: str, large: bool = False) -> DataFrame:
    """``df`` cut from its lineage by a Parquet table in the shared folder; before a large one finished shuffles are let go.

    Executors may be lost at any time after this: the table is read again, nothing is recomputed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    if large:
        release(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch that the JVM hands to Python while an operator writes its tables, under this setting.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


class Scratch:
    """Tables written for one operator; all go at its end but those it keeps.

    What an operator returns rests on a kept table, so a lost executor needs none of the others. While
    they are written Arrow batches are small; at the end the session has its own setting again.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        self.batch = self.spark.conf.get(BATCH)
        self.spark.conf.set(BATCH, BATCH_BYTES)
        return self

    def written(self, df: DataFrame, name: str, large: bool = False) -> DataFrame:
        out = written(df, name, large)
        self.paths += [f.rpartition("/")[0] for f in out.inputFiles()[:1]]
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no plan still to come reads."""
        for table in tables:
            self._delete([f.rpartition("/")[0] for f in table.inputFiles()[:1]])

    def _delete(self, paths: list[str]) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in map(hadoop, paths):
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def __exit__(self, *_) -> None:
        self.spark.conf.set(BATCH, self.batch)
        self._delete(self.paths)
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sliced(batches: Iterator[pa.RecordBatch], column: int | str, rows: int = 256, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """``batches`` in slices of at most ``rows`` rows and about ``size`` bytes of text: long texts come a few at a time."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo, before = 0, 0
        while lo < batch.num_rows:
            hi = max(lo + 1, min(lo + rows, int(np.searchsorted(ends, before + size, "right"))))
            yield batch.slice(lo, hi - lo)
            lo, before = hi, int(ends[hi - 1])


def trim() -> None:
    """In a Python worker, give freed memory back: idle workers of earlier stages share the executor's limit."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def text_keys(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: together the identity of a text, the same on every run."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def private(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever signs their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns whose names, in any case, an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has been counted to be small, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
