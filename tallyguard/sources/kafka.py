"""Kafka topics as raw event text. Needs the Spark Kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyguard.config import JobConfig


def kafka_options(config: JobConfig, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    """A first run starts at the earliest offset; later runs resume from the query's checkpoint."""
    if not config.bootstrap_servers:
        raise ValueError("KAFKA_BOOTSTRAP_SERVERS is not set")
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "groupIdPrefix": config.group_id,
        "failOnDataLoss": "true",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def stream_topic(
    spark: SparkSession, config: JobConfig, topic: str, max_offsets: int | None = None
) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_options(config, topic, max_offsets))
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def read_topic(spark: SparkSession, config: JobConfig, topic: str) -> DataFrame:
    """Everything the topic holds now, as a batch."""
    options = {**kafka_options(config, topic), "endingOffsets": "latest"}
    return spark.read.format("kafka").options(**options).load().selectExpr("CAST(value AS STRING) AS value")
