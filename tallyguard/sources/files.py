"""JSON-lines files with one event per line, as a batch or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyguard.contracts import DETAIL_TOPIC, ORDER_TOPIC, PAYMENT_TOPIC


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def topic_files(base: str) -> dict[str, str]:
    """The three topics' files or folders below ``base``."""
    return {topic: f"{base}/{topic}" for topic in (ORDER_TOPIC, DETAIL_TOPIC, PAYMENT_TOPIC)}
