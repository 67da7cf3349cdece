"""The corpus pipeline: five stages, each written as Parquet and reread by the next.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reachset.llm.common import materialize
from reachset.llm.exact_dedup import drop_copies
from reachset.llm.jaccard_join import keep_one
from reachset.llm.mixing import mixed_rows
from reachset.llm.packing import pack
from reachset.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return drop_copies(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at 0.8 on five-word shingles one document stays."""
    return keep_one(docs, n=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix, with their place in sequences of 4096 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Scores, similarity groups, sampling and packing are beyond SQL; tests/llm holds
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
