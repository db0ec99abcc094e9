"""Document fingerprints from closed syncmers.

A k-mer is a closed syncmer if its least s-mer stands at its start or its end. The choice looks at
nothing outside the k-mer, so a text keeps its syncmers wherever it is pasted, and each window of
``k - s`` k-mers holds one. A fingerprint keeps, of a text's distinct syncmers, the ``ANCHORS`` of
least hash in their order in the text; two fingerprints are alike by the share of anchors of their
joint bottom sketch that both have, in one order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import windows as W
from .common import partitions, read, sliced, trim

#: Lengths in code points of a k-mer and its inner s-mers, and anchors of a fingerprint.
K, S, ANCHORS = 12, 5, 64
#: Bytes of text of one range of keys, and the most ranges (their bounds are held by the driver); ranges are streamed.
PART_BYTES, MOST_PARTS = 16 << 20, 20_000


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def syncmers(points: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 64-bit hashes of the closed syncmers; none in a text shorter than ``k``."""
    if len(points) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = W.prefix_sums(W.mix(points.astype(np.uint64) + np.uint64(1)))
    inner = W.hashes(sums, 0, len(points) - s + 1, s)
    least = W.sliding_min(inner, k - s + 1)
    at = np.flatnonzero((inner[: len(least)] == least) | (inner[k - s :][: len(least)] == least))
    return at, W.mix((sums[at + k] - sums[at]) * W._power("down", W._INVERSE, len(points))[at])


def sketch(at: np.ndarray, value: np.ndarray, text: str) -> np.ndarray:
    """The bottom ``ANCHORS`` distinct syncmers as 32-bit hashes in text order; of a repeated one its first place.

    A text without syncmers gets one hash of the whole text, an empty one none.
    """
    if not len(at):
        return np.array([int.from_bytes(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:4], "big")] if text else [], np.uint32)
    # only the low end can make it; ties of the full hash are the same k-mer
    if len(value) > 4 * ANCHORS:
        cut = np.partition(value, 4 * ANCHORS)[4 * ANCHORS]
        low = value <= cut
        if len(np.unique(value[low])) >= ANCHORS:
            at, value = at[low], value[low]
    kinds, first = np.unique(value, return_index=True)
    first = first[:ANCHORS]
    top = (kinds[:ANCHORS] >> np.uint64(32)).astype(np.uint32)
    return top[np.argsort(at[first], kind="stable")]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: shared anchors in one order, over the least ``ANCHORS`` of both; two empty texts are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b) and (a == b).all():
        return 1.0
    union = np.union1d(a, b)[:ANCHORS]
    shared = np.intersect1d(np.intersect1d(a, b), union)
    if not len(shared):
        return 0.0
    place = {x: i for i, x in enumerate(b.tolist())}
    among = set(shared.tolist())
    tails: list[int] = []
    for x in a.tolist():
        if x in among:
            p = place[x]
            i = bisect_left(tails, p)
            tails[i : i + 1] = [p]
    return len(tails) / len(union)


def as_text(anchors: np.ndarray) -> str:
    return anchors.astype(">u4").tobytes().hex()


def edited_syncmers(text: str, cut: int, mine: tuple, following: str, m: int, theirs: tuple, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Syncmers of ``text[:cut] + following[:m]`` from those of both; only the k-mers across the seam are looked at anew."""
    head, tail = mine[0] <= cut - k, theirs[0] <= m - k
    seam = text[max(0, cut - k + 1) : cut] + following[: min(m, k - 1)]
    at, value = syncmers(code_points(seam))
    begin = max(0, cut - k + 1)
    return np.concatenate((mine[0][head], at + begin, theirs[0][tail] + cut)), np.concatenate((mine[1][head], value, theirs[1][tail]))


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition, by part and then in order; each document meets the one after it.

    The last of a part is followed by a copy of the next part's first, marked as a halo.
    """
    held = None
    for batch in sliced(batches, "text"):
        rows: list[tuple] = []
        parts, halos, ids = (batch.column(c).to_pylist() for c in ("part", "halo", "doc_id"))
        for part, halo, doc, x in zip(parts, halos, ids, batch.column("text")):
            text = x.as_py() or ""
            if held is not None and held[0] != part:
                held = None
            if held is None and halo:  # further copies of a halo
                continue
            found = syncmers(code_points(text))
            now = (part, doc, text, found, sketch(*found, text))
            if held is not None:
                rows.append(_row(held, now))
            held = None if halo else now
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in OUT.split(", ")])
    trim()


def _row(held: tuple, after: tuple) -> tuple:
    _, doc, text, mine, own = held
    _, _, following, theirs, next_ = after
    third = len(text) // 3
    cut, m = len(text) - third, min(third, len(following))
    edited = text[:cut] + following[:m]
    changed = own if edited == text else sketch(*edited_syncmers(text, cut, mine, following, m, theirs), edited)
    return doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(own), as_text(changed), likeness(own, changed), likeness(own, next_)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``, in the columns OUT: its fingerprint, its edited text's, and their likeness.

    The edited text is the text with its last third of code points replaced by the first as many of
    the next document's; next is the one of next lower key, for the lowest the highest. Rows of equal
    keys are ordered by a hash of their texts; null keys come last, in that order. Null texts are
    empty. A sole document is its own next one. Keys are integers.

    Documents are dealt out by ranges of the key, whose bounds are keys; the first document of each
    range is sent to the range before it too.
    """
    spark = docs.sparkSession
    size, rows = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`"))), F.count("*")).first()
    if not rows:
        return spark.createDataFrame([], OUT)
    parts = min(MOST_PARTS, max(partitions(spark), -(-int(size or 0) // PART_BYTES)))
    lowest = -(1 << 63)
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(key).cast("long"), F.lit(lowest)).alias("order"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("tie"), F.col(f"`{text}`").alias("text"))
    # bounds are keys that occur, highest first; a range begins at its bound
    found = plain.agg(F.max("order").alias("top"), F.percentile_approx("order", [i / parts for i in range(1, parts)] or [0.5], max(10_000, 4 * parts)).alias("q")).first()
    bounds = sorted({found.top, *found.q}, reverse=True)
    bounds_array = F.lit(bounds[::-1])
    below = _search(bounds_array, len(bounds))
    part = F.lit(len(bounds) - 1) - below
    first_of = F.element_at(bounds_array, (below + 1).cast("int")) == F.col("order")
    to = F.when(first_of, F.array(F.struct(part.alias("part"), F.lit(False).alias("halo")), F.struct(F.pmod(part - 1, F.lit(len(bounds))).alias("part"), F.lit(True).alias("halo")))).otherwise(F.array(F.struct(part.alias("part"), F.lit(False).alias("halo"))))
    dealt = plain.withColumn("to", F.explode(to)).select("to.part", "to.halo", "doc_id", "order", "tie", "text")
    ordered = dealt.repartitionByRange(len(bounds), "part").sortWithinPartitions("part", "halo", F.desc("order"), "tie")
    return ordered.select("part", "halo", "doc_id", "text").mapInArrow(_ordered, OUT)


def _search(ascending, n: int):
    """Index of the least element of the array literal that is not below ``order``: binary search, unrolled."""
    low, high = F.lit(0), F.lit(n - 1)
    steps = max(1, (n - 1).bit_length())
    state = F.struct(low.alias("lo"), high.alias("hi"))

    def narrow(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        up = F.get(ascending, mid) < F.col("order")
        return F.struct(F.when(up & (s["lo"] < s["hi"]), mid + 1).otherwise(s["lo"]).cast("int").alias("lo"), F.when(up, s["hi"]).otherwise(F.least(mid, s["hi"])).cast("int").alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps + 1)), state, narrow, lambda s: s["lo"])


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document."""
    return fingerprints(read(spark, sf_dir, "documents").select("doc_id", "text"))
