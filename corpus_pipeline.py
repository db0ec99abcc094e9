"""The training-corpus pipeline: five stages, each a table of documents but the last, which packs them.

Rejected: documents that the toxicity classifier scores 0.5 or more (its model is trained on the
labels of the documents at hand), all but the least doc_id of each group of near copies (five-word
shingles, similarity 0.8), and documents that hold a benchmark item. Passages of 50 words or more
that occur elsewhere too are cut out of the texts that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.llm import decontamination, jaccard_join, packing, suffix_dedup
from pricewright.llm import toxicity as tox
from pricewright.llm.common import columns, private, read, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier scores under 0.5, with all their columns; a null text counts as empty, an empty table stays empty."""
    score, predicted = private(docs, "score", "predicted")
    scored = tox.score(docs, tox.train(docs, read(spark, sf_dir, "labels")), added=(score, predicted))
    return scored.filter(F.col(predicted) == 0).select(*columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links of 0.8 or more join, the one of least doc_id; texts without words all stay."""
    return jaccard_join.one_of_each(docs, "doc_id", words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages of 50 or more that occur elsewhere too; n_chars follows the text, nulls stay null."""
    kept = suffix_dedup.suffix_dedup(docs, width=50, unit="words", report=False)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*columns(docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item (80 % of its five-word shingles); null and blank texts stay."""
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of each document, in length buckets and batches; a document without words has one empty piece."""
    return packing.pack(docs, shards=packing.shards_for(spark))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark", benchmark),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the dynamic program; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the others are written to the shared folder as they end."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name, large=True)
    return STAGES[-1][1](spark, docs, sf_dir)
