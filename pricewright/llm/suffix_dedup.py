"""Suffix-array dedup by depth-limited radix sort.

A suffix is ordered only through its first ``width`` tokens (its window), by most-significant-digit
passes; after each pass only groups of two or more go on, and the groups that are left after the last
are exactly the repeated windows. Which tokens make the first digits is chosen so that few are looked at:

1. The first digit is the ``digit``-token string at the window's anchor (see ``windows``): equal windows
   have it at the same offset. Consecutive windows of one anchor are one *run* and have one row, so
   the pass deals out about one row in 90 places; a run whose digit occurs nowhere else is done.
2. Runs of one first digit are ordered by the rest of their tokens as one digit (told by two independent
   64-bit hashes): a run that occurs again is repeated as a whole.
3. Of the distinct runs that share the first digit and differ in the second the windows are ordered,
   each at its own offset, by digits of 8 bytes (or one word) of the text itself, within a task.

Nothing is sampled but the place of the first digit, and that depends on the window alone, so no equal
pair is parted. Groups are spread by key; pass 2 counts with partial aggregation. If very many distinct
runs share a first digit, their windows go by a second one that is nearly the whole window: the tokens
that all windows of a block of offsets have. What is equal within a batch of a task meets there first
and goes on once, so no task holds the group of a hot passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import windows as W
from .common import Scratch, columns, partitions, private, read, sliced, text_keys, trim, without, written
from .shingles import word_spans, word_values

#: Runs of one first digit whose windows stay together in pass 3; those of a larger group are dealt out by blocks of offsets (so many a window) and the tokens that a block shares.
SPLIT, BLOCKS = 64, 16
#: Windows that meet within a batch of pass 3, and that make up one group of its shuffle.
MEET, GROUP = 300_000, 400_000

ADDED = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def _tokens(text: bytes, unit: str) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Token values, and for words where each begins and ends in the bytes."""
    raw = np.frombuffer(text, np.uint8)
    if unit == "bytes":
        return W.BYTE_VALUES[raw], None, None
    begin, end = word_spans(raw)
    return word_values(raw, begin, end), begin, end


def _texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    for x in column:
        yield (x.as_buffer().to_pybytes() if x.is_valid else b"")


def _runs(unit: str, width: int, digit: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2):
            found: list[list[np.ndarray]] = [[] for _ in RUN_SCHEMA.split(",")]
            k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, text in enumerate(_texts(batch.column(2))):
                values, _, _ = _tokens(text, unit)
                start, n, akey, offset = W.runs(values, width, digit)
                if not len(start):
                    continue
                source = text if unit == "bytes" else values.tobytes()
                scale = 1 if unit == "bytes" else 8
                lo, hi = (start * scale).tolist(), ((start + n + width - 1) * scale).tolist()
                rest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(source[a:b]) for a, b in zip(lo, hi)), np.int64).reshape(-1, 2)
                for into, x in zip(found, (akey.view(np.int64), rest[:, 0], rest[:, 1], np.full(len(n), k1[i]), np.full(len(n), k2[i]), start.astype(np.int32), n.astype(np.int32), offset.astype(np.int32))):
                    into.append(x)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in found], names=[c.split()[0] for c in RUN_SCHEMA.split(", ")])
        trim()

    return step


RUN_SCHEMA = "akey long, rest long, rest2 long, k1 long, k2 long, start int, n int, offset int"
WINDOW_SCHEMA = "bucket int, k1 long, k2 long, start int, akey long, offset int, known boolean, lo int, hi int, data binary"
SPAN_SCHEMA = "k1 long, k2 long, lo int, hi int"


class _Runs:
    """Windows of runs in memory, ordered by digits. ``data``: the tokens of each run; ``offset``: of the anchor in its first window."""

    def __init__(self, unit: str, width: int, data: list[bytes], akey: list[int], offset: list[int], known: list[bool]):
        scale = 1 if unit == "bytes" else 8
        size = np.array([len(x) // scale for x in data], np.int64)
        n = size - width + 1
        self.row = np.repeat(np.arange(len(data)), n)
        self.at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        self.offset = np.array(offset, np.int64)[self.row] - self.at
        self.known = np.array(known, bool)[self.row]
        key = np.array(akey, np.int64)[self.row]
        order = np.lexsort((self.offset, key))
        new = np.concatenate(([False], (np.diff(key[order]) != 0) | (np.diff(self.offset[order]) != 0))) if len(order) else np.zeros(0, bool)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new)
        raw = b"".join(data)
        step = min(8, width) if unit == "bytes" else 1
        digits = W.byte_digits(np.frombuffer(raw, np.uint8), step) if unit == "bytes" else np.frombuffer(raw, np.uint64)
        places = [*range(0, width - step + 1, step)] + ([width - step] if width % step else [])
        leader = W.equal_windows(digits, self.at + np.repeat(np.cumsum(size) - size, n), group, places)
        #: whether a window is the first of its equals, and whether it is repeated here or known to be
        self.first = leader == np.arange(len(leader))
        self.twice = (np.bincount(leader, minlength=1)[leader] > 1) | (np.bincount(leader, weights=self.known, minlength=1) > 0)[leader]


def _windows(unit: str, width: int, digit: int, buckets: int):
    """Entries of pass 3: the tokens of the runs listed for a text, whole or, of hot first digits, in blocks of offsets.

    Windows that occur twice in a batch are known to be repeated: the runs they come from get their
    reply here, and one of them goes on to tell the other batches.
    """
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    block, scale = max(1, width // BLOCKS), 1 if unit == "bytes" else 8

    def flush(runs: list[dict]) -> pa.RecordBatch:
        w = _Runs(unit, width, [r["data"] for r in runs], [r["akey"] for r in runs], [r["offset"] for r in runs], [r["known"] for r in runs])
        out: dict[str, list] = {c.split()[0]: [] for c in WINDOW_SCHEMA.split(", ")}

        def put(**x) -> None:
            for c, into in out.items():
                into.append(x.get(c))

        hit = w.twice & ~w.known
        for i, lo, hi in _reach(w.row[hit], w.at[hit]):
            r = runs[i]
            put(bucket=i % buckets, k1=r["k1"], k2=r["k2"], start=r["start"], lo=r["start"] + lo, hi=r["start"] + hi + width)
        part = np.where(np.array([r["hot"] for r in runs])[w.row], w.offset // block, -1)
        keep = np.flatnonzero(w.first)
        row, at, part, flag = w.row[keep], w.at[keep], part[keep], (w.twice | w.known)[keep]
        cut = np.flatnonzero(np.concatenate(([True], (np.diff(row) != 0) | (np.diff(at) != 1) | (np.diff(part) != 0) | (flag[1:] != flag[:-1])))) if len(keep) else keep
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(keep)]):
            r, lo, hi, p = runs[int(row[a])], int(at[a]), int(at[b - 1]) + 1, int(part[a])
            key = r["akey"].to_bytes(8, "little", signed=True)
            if p >= 0:  # what every window of the block has, whichever of them this run has
                least, most = p * block, min(p * block + block - 1, width - digit)
                key += r["data"][(r["offset"] - least) * scale : (r["offset"] - most + width) * scale]
            put(bucket=xxhash.xxh3_64_intdigest(key, p + 1) % buckets, k1=r["k1"], k2=r["k2"], start=r["start"] + lo, akey=r["akey"], offset=r["offset"] - lo, known=bool(flag[a]), data=r["data"][lo * scale : (hi + width - 1) * scale])
        return pa.RecordBatch.from_arrays([pa.array(out[c.split()[0]], kinds[c.split()[1]]) for c in WINDOW_SCHEMA.split(", ")], names=list(out))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, size, before = [], 0, None
        for batch in sliced(batches, "text"):
            lists = batch.column("runs").to_pylist()
            k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
            for i, text in enumerate(_texts(batch.column("text"))):
                if (k1[i], k2[i]) == before:  # a copy of the text above it
                    continue
                before = (k1[i], k2[i])
                source = text if unit == "bytes" else _tokens(text, unit)[0].tobytes()
                for x in lists[i]:
                    runs.append(x | {"k1": k1[i], "k2": k2[i], "data": source[x["start"] * scale : (x["start"] + x["n"] + width - 1) * scale]})
                    size += x["n"]
                if size >= MEET:
                    yield flush(runs)
                    runs, size = [], 0
        if runs:
            yield flush(runs)
        trim()

    return step


def _reach(row: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """First and last repeated window of each run; a run has fewer windows than ``width``, so all between is covered."""
    if not len(row):
        return []
    rows, where = np.unique(row, return_inverse=True)
    lo, hi = np.full(len(rows), np.iinfo(np.int64).max), np.full(len(rows), -1)
    np.minimum.at(lo, where, at)
    np.maximum.at(hi, where, at)
    return list(zip(rows.tolist(), lo.tolist(), hi.tolist()))


def _replies(unit: str, width: int):
    def step(table: pa.Table) -> pa.Table:
        told = table.filter(pc.is_valid(table["lo"])).select(["k1", "k2", "lo", "hi"])
        asked = table.filter(pc.is_null(table["lo"]))
        rows = asked.select(["k1", "k2", "start", "akey", "offset", "known"]).to_pylist()
        if not rows:
            return told
        w = _Runs(unit, width, list(_texts(asked["data"])), *([r[c] for r in rows] for c in ("akey", "offset", "known")))
        hit = w.twice & ~w.known
        found = [(rows[r]["k1"], rows[r]["k2"], rows[r]["start"] + lo, rows[r]["start"] + hi + width) for r, lo, hi in _reach(w.row[hit], w.at[hit])]
        trim()
        names = ["k1", "k2", "lo", "hi"]
        new = pa.table([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=names)
        return pa.concat_tables([told.cast(new.schema), new])

    return step


def repeated_spans(docs: DataFrame, width: int, unit: str = "bytes", text: str = "text") -> DataFrame:
    """(k1, k2, spans): for each distinct text, token intervals that windows occurring elsewhere cover.

    The keys are those of ``common.text_keys``; texts without such windows have no row. Intervals may
    overlap. A null text is an empty one; copies of a text stand for one another.
    """
    with Scratch(docs.sparkSession) as scratch:
        return _repeated_spans(docs, width, unit, text, scratch)


def _repeated_spans(docs: DataFrame, width: int, unit: str, text: str, scratch: Scratch) -> DataFrame:
    spark = docs.sparkSession
    digit = max(1, width // 2)
    k1, k2 = text_keys(F.col(f"`{text}`"))
    keyed = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(f"`{text}`").alias("text"))
    runs = scratch.written(keyed.mapInArrow(_runs(unit, width, digit), RUN_SCHEMA), "runs")
    # pass 1: first digits met twice or more, and whether what follows them differs
    # a table of its own, so that the join with it deals out both sides and a hot digit's rows can be split
    differ = (F.min("rest") != F.max("rest")) | (F.min("rest2") != F.max("rest2"))
    met_digits = scratch.written(runs.groupBy("akey").agg(F.count("*").alias("occ"), differ.alias("mixed")).filter("occ > 1"), "digits")
    met = scratch.written(runs.join(met_digits, "akey"), "met", large=True)
    scratch.drop(runs)
    alike, mixed = met.filter("not mixed"), met.filter("mixed")
    # pass 2, with one occurrence of each distinct run; `first` takes all of them from the same row
    same = ["akey", "rest", "rest2"]
    status = scratch.written(mixed.groupBy(*same).agg(F.count("*").alias("c"), *[F.first(x).alias(x) for x in ("k1", "k2", "start", "n", "offset", "occ")]), "status", large=True)
    again = mixed.join(status.filter("c > 1").select(*same), same).select(*alike.columns)
    whole = alike.unionByName(again).select("k1", "k2", F.col("start").alias("lo"), (F.col("start") + F.col("n") + F.lit(width - 1)).cast("int").alias("hi")).distinct()
    # pass 3
    total = status.agg(F.sum("n")).first()[0] or 0
    buckets = max(partitions(spark) * 8, -(-total // GROUP))
    listed = status.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "akey", "offset", (F.col("c") > 1).alias("known"), (F.col("occ") > SPLIT).alias("hot"))).alias("runs"))
    # a table, so that the join deals out both sides and a hot text's rows can be split: copies of a text have known runs only, so it does no harm if two tasks look at them
    listed = scratch.written(listed, "listed")
    entries = keyed.join(listed, ["k1", "k2"]).select("k1", "k2", "text", "runs").mapInArrow(_windows(unit, width, digit, buckets), WINDOW_SCHEMA)
    replies = scratch.written(entries.groupBy("bucket").applyInArrow(_replies(unit, width), SPAN_SCHEMA), "replies", large=True)
    spans = whole.unionByName(replies).groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return written(spans, "spans", large=True)


def _cut(unit: str, keep_text: bool, text_at: int, fields: list[str], report: bool):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_at):
            out: list[list] = [[], [], [], []]
            kept_texts = []
            spans = batch.column(batch.num_columns - 1)
            for i, text in enumerate(_texts(batch.column(text_at))):
                kept, removed, n = text, 0, 0
                if spans[i].is_valid and len(spans[i]):
                    x = spans[i].values
                    lo, hi = W.merge(x.field(0).to_numpy().astype(np.int64), x.field(1).to_numpy().astype(np.int64))
                    if unit == "words":
                        begin, end = word_spans(np.frombuffer(text, np.uint8))
                        lo, hi = begin[lo], end[hi - 1]
                    edges = [0, *np.column_stack((lo, hi)).ravel().tolist(), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    removed, n = len(text) - len(kept), len(lo)
                for into, value in zip(out, (len(text), removed, n, hashlib.sha256(kept).hexdigest())):
                    into.append(value)
                kept_texts.append(kept.decode("utf-8", "ignore") if batch.column(text_at)[i].is_valid else None)
            kept_columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            if keep_text:
                kept_columns[text_at] = pa.array(kept_texts, pa.string())
            added = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())]
            yield pa.RecordBatch.from_arrays([*kept_columns, *(added if report else ())], names=[*fields, *(ADDED if report else ())])
        trim()

    return step


def suffix_dedup(docs: DataFrame, width: int = 400, unit: str = "bytes", text: str = "text", keep_text: bool = True, report: bool = True) -> DataFrame:
    """``docs`` with every token removed that a ``width``-token window covers which also starts elsewhere.

    ``unit`` is ``bytes`` (UTF-8) or ``words`` (split at ASCII white space; the bytes from a removed
    run's first word to its last go). Windows are judged on the input and all their occurrences go.
    ``keep_text`` puts what is left in the text column (bytes of a character cut in two are dropped
    there); if false, the text stays as it is. With ``report`` the columns ADDED follow: n_bytes,
    n_removed, n_spans, kept_sha256 (of the bytes left, before decoding).

    Nulls: a null text counts as empty and stays null. Texts shorter than ``width`` stay whole, very long
    ones are read whole. Repeated rows count as copies: each loses its windows. Columns of ``docs`` with
    the names added are replaced; all others, doc_id included, may hold anything. An empty table gives
    an empty one.
    """
    added = ADDED if report else ()
    base = without(docs, *added)
    k1, k2, spans = private(base, "k1", "k2", "spans")
    h1, h2 = text_keys(F.col(f"`{text}`"))
    found = repeated_spans(docs, width, unit, text).withColumnsRenamed({"k1": k1, "k2": k2, "spans": spans})
    joined = base.withColumns({k1: h1, k2: h2}).join(found, [k1, k2], "left").select(*columns(base), spans)
    schema = base.withColumns({c: F.lit(None).cast("string" if c == "kept_sha256" else "long") for c in added}).schema
    return joined.mapInArrow(_cut(unit, keep_text, base.columns.index(text), base.columns, report), schema)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, text) of every document: 400-byte strings that start elsewhere too are cut.

    n_bytes is of the whole text, before anything is cut; text is what is left of it.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup(docs, 400, "bytes").select("doc_id", *ADDED, "text")
