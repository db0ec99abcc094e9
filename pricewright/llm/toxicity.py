"""Toxicity: a counterfactually regularised logistic classifier over words and word beginnings.

Each labelled text with identity terms gets a twin in which every such term is swapped for another
of its category; besides log loss and an L2 term, training minimises the squared difference of the
two logits. What a mention of a group adds to the score shrinks, whatever the labels' bias.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, sliced, trim, without, written

#: Identity terms by category; a term is swapped for the next one of its category.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("girl", "boy"),
    ("gay", "lesbian", "straight", "bisexual", "queer"), ("transgender", "cisgender"), ("trans", "cis"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("african", "european", "american", "arab"), ("immigrants", "refugees", "citizens"), ("immigrant", "refugee", "citizen"),
    ("disabled", "blind", "deaf"), ("elderly", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("flüchtlinge", "bürger"), ("ausländer", "deutsche"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "citoyens"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "ciudadanos"),
)
SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY for i, term in enumerate(group)}
BEGINNINGS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    """The words, and ``^`` with the beginning of each longer word."""
    found = set(words)
    for n in BEGINNINGS:
        found.update("^" + w[:n] for w in words if len(w) > n)
    return found


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        found = self.weights.keys() & features_of(words_of(text or ""))
        z = self.bias + sum(self.weights[x] for x in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 0):
        own, twin = [], []
        for x in batch.column(0):
            words = words_of(x.as_py() or "")
            own.append(sorted(features_of(words)))
            twin.append(sorted(features_of({SWAP.get(w, w) for w in words})) if words & SWAP.keys() else None)
        kind = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, kind), pa.array(twin, kind)], names=["y", "own", "twin"])
    trim()


def _indexed(index: dict[str, int]):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for b in batches:
            own, twin = ([sorted(index[f] for f in x.as_py() if f in index) if x.is_valid else None for x in b.column(i)] for i in (1, 2))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, kind), pa.array(twin, kind)], names=["y", "own", "twin"])

    return step


def _fit(rows: list, n: int, l2: float, fairness: float, rounds: int = 400, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Adam on the whole sample; ``rows`` in any order give the same sums but for rounding, so they come sorted."""

    def flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([np.zeros(0, np.int64), *(np.asarray(x, np.int64) for x in lists)]), np.repeat(np.arange(len(lists)), [len(x) for x in lists])

    y = np.array([r.y for r in rows], float)
    col, row = flat([r.own for r in rows])
    pairs = [i for i, r in enumerate(rows) if r.twin is not None]
    twin_col, twin_row = flat([rows[i].twin for i in pairs])
    own_col, own_row = flat([rows[i].own for i in pairs])
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    w = np.zeros(n + 1)
    w[n] = np.log(base / (1 - base))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(row, w[col], len(y)) + w[n]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.append(np.bincount(col, err[row], n) + l2 * w[:n], err.sum())
        if pairs:
            gap = np.bincount(own_row, w[own_col], len(pairs)) - np.bincount(twin_row, w[twin_col], len(pairs))
            push = 2 * fairness * gap / len(pairs)
            g[:n] += np.bincount(own_col, push[own_row], n) - np.bincount(twin_col, push[twin_row], n)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:n], float(w[n])


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = 20_000, vocabulary: int = 2000, min_df: int = 5, l2: float = 1e-4, fairness: float = 1.0) -> Model:
    """Fit on at most about ``max_train_rows`` of the labelled rows with crc32(doc_id) mod 5 other than 0.

    The sample takes the rows whose hash of doc_id is least, so it is the same on every run. Features
    are the ``vocabulary`` ones of highest chi-square among those in ``min_df`` texts or more (half that in
    small samples), and the identity terms. Rows with a null doc_id or label are not used; a doc_id
    labelled more than once is toxic if any of its labels says so, and of rows that repeat a doc_id one
    is taken, the least by text. With no usable row or just one class the model scores every text by
    the base rate; texts without words have no features. No other column is looked at.
    """
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0).groupBy("doc_id").agg(F.max("y").alias("y"))
    share = min(1.0, max_train_rows / max(1, known.count()))
    taken = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) < max(1, int(share * (1 << 52))))
    # at most about max_train_rows rows of two numbers
    sample = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y")
    found = written(sample.mapInArrow(_features, "y int, own array<string>, twin array<string>"), "features")
    n, positive = found.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n or not 0 < positive < n:
        base = min(max(positive / n if n else 0.0, 1e-3), 1 - 1e-3)
        return Model({}, float(np.log(base / (1 - base))))
    least = min(min_df, max(2, n // 200))
    counts = found.select("y", F.explode("own").alias("f")).groupBy("f").agg(F.count("*").cast("double").alias("df"), F.sum("y").cast("double").alias("pos")).filter(F.col("df") >= least)
    gap = F.col("pos") - F.col("df") * (positive / n)
    chi = counts.withColumn("chi", gap * gap / (F.col("df") * (F.lit(1.0) - F.col("df") / F.lit(float(n)) + 1e-9)))
    best = [r.f for r in chi.orderBy(F.desc("chi"), "f").limit(vocabulary).collect()]
    names = sorted({*best, *SWAP})
    rows = found.mapInArrow(_indexed({f: i for i, f in enumerate(names)}), "y int, own array<int>, twin array<int>").collect()
    rows.sort(key=lambda r: (r.y, r.own, r.twin or []))
    weights, bias = _fit(rows, len(names), l2, fairness)
    return Model({f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-6}, bias)


def score(docs: DataFrame, model: Model, text: str = "text", added: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), from the whole text alone.

    A null text counts as empty and gets the score of no feature at all; equal texts score alike, an
    empty table gives an empty one. Columns of the names ``added`` are replaced, others stay.
    """
    base = without(docs, *added)
    names = [*base.columns, *added]
    at = names.index(text)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at):
            scores = [model.score(x.as_py()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=names)
        trim()

    schema = base.withColumns({added[0]: F.lit(0.0), added[1]: F.lit(0)}).schema
    return base.mapInArrow(step, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, by a model of the labels of those not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
