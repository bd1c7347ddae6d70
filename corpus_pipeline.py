"""The corpus pipeline: quality, near-duplicates, benchmark passages, secrets, mix.

Each stage gets the documents its predecessor kept, whole, and returns documents in the
columns it was given; the last returns the mix. Null texts count as empty throughout.
Several rows of one id are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumeline.llm import copies, decontaminate, mixing, quality, secrets
from fumeline.llm.common import batches_of, remainder, table
from fumeline.session import stage, unstage

LEAST_QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 9) accepts."""
    batches_of(spark)
    weights = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", remainder("doc_id", 5) != 0)
    return quality.accepted(docs, weights, LEAST_QUALITY)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: five-word shingles, Jaccard 0.8.

    Operator 4's fingerprints and bit planes find the nearest, of five words; what lies beyond its two bits is
    found by keys. All are compared exactly.
    """
    batches_of(spark)
    return copies.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark cut out (operator 10)."""
    batches_of(spark)
    return measured(decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked (operator 8)."""
    batches_of(spark)
    return measured(secrets.redacted(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources (operator 3)."""
    batches_of(spark)
    return mixing.mixture(docs)


def measured(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, as the text has now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontaminate", without_benchmark),
    ("secrets", without_secrets),
    ("mix", mixed),
]

# Hashes, a trained model and random draws decide; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
        if before is not None:
            unstage(before)  # nothing reads it once the next one stands
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
