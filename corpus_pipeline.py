"""From raw documents to packed token sequences: the stages of a training-data pipeline.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read
again as the next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyguard.llm import near_dup, packing, pii, toxicity
from tallyguard.llm.common import shipping, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the model's cut."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    return near_dup.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in the texts."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in token sequences."""
    return packing.packed(docs)


STAGES = [
    (name, shipping(stage))
    for name, stage in [("toxicity", drop_toxic), ("near_dup", one_of_each), ("pii", redact), ("packing", pack)]
]

# Neither the regression nor the fingerprints can be expressed in DuckDB's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
