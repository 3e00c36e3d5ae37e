"""The streaming plans run over tables: events become topic files, files become a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyguard.contracts import EVENT_SCHEMA, MONEY, PAYMENT_FAILED, PAYMENT_TOPIC, STATUS_OF_TYPE, TOPIC_EVENT_TYPES
from tallyguard.functions.times import business_date
from tallyguard.sinks.shared import remove_folder, shared_folder
from tallyguard.sources.files import stream_lines
from tallyguard.sources.render import topic_json
from tallyguard.streaming.intake import state_session, stream_events


# State partitions that a session of few threads may have.
FEW_PARTITIONS = 12
# Records of a topic file. Compressed files are read whole by a task, so many small ones keep all threads busy.
FILE_RECORDS = 100_000


def state_partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions, but no more than it has threads.

    A state partition opens a store, syncs its files and starts a Python worker per operator and
    micro-batch, half a second whatever it holds, so more of them than threads only add to the time. They
    need no more memory for more rows: stores keep theirs on disk, and processors take a slice at a time.
    """
    threads = max(FEW_PARTITIONS, spark.sparkContext.defaultParallelism)
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), threads)


def closing_event(spark: SparkSession, time_ms: int | None) -> DataFrame:
    """A failed payment of nobody, late enough to let every window and wait end."""
    last = spark.range(1).select(F.lit(time_ms).cast("bigint").alias("time"))
    values = {
        "event_id": F.lit("closing"),
        "event_type": F.lit(PAYMENT_FAILED),
        "event_time_ms": F.col("time"),
        "business_date": business_date(F.col("time")),
        "order_id": F.lit(-1),
        "user_id": F.lit(-1),
        "payment_id": F.lit(-1),
        "payment_status": F.lit(STATUS_OF_TYPE[PAYMENT_FAILED]),
        "payment_amount": F.lit(0).cast(MONEY),
        "payment_time_ms": F.col("time"),
    }
    return last.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
    )


def write_topics(events: DataFrame, topics: list[str], folder: str, after_ms: int) -> dict[str, str]:
    """The events as compressed JSON lines, one folder per topic, closed by one late payment.

    The newest event time is observed while the topics are written, so that no event is derived twice.
    """
    paths = {topic: f"{folder}/{topic}" for topic in topics}
    newest = []
    for topic, path in paths.items():
        observation = Observation()
        mine = events.filter(F.col("event_type").isin(*TOPIC_EVENT_TYPES[topic]))
        seen = mine.observe(observation, F.max("event_time_ms").alias("newest_ms"))
        topic_json(seen, topic).write.option("maxRecordsPerFile", FILE_RECORDS).text(path, compression="gzip")
        newest.append(observation.get["newest_ms"])
    known = [ms for ms in newest if ms is not None]
    closing = closing_event(events.sparkSession, max(known) + after_ms if known else None)
    topic_json(closing, PAYMENT_TOPIC).write.mode("append").text(paths[PAYMENT_TOPIC], compression="gzip")
    return paths


def run_over_tables(
    spark: SparkSession,
    events: DataFrame,
    topics: list[str],
    rules: Callable[[DataFrame], DataFrame],
    after_ms: int,
) -> DataFrame:
    """Feed all events through a streaming plan and return what it wrote; topics and checkpoint go once it is done."""
    folder = shared_folder(spark, "stream")
    session = state_session(spark, state_partitions(spark))
    # Counting them looks every written and removed row up once more.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    # Of a state that lives for two micro-batches a changelog would be one more copy beside the first snapshot.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "false")
    try:
        paths = write_topics(events, topics, f"{folder}/in", after_ms)
        alerts = rules(stream_events({topic: stream_lines(session, path) for topic, path in paths.items()}))
        query = (
            alerts.writeStream.format("parquet")
            .option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for scratch in ("in", "checkpoint"):
            remove_folder(spark, f"{folder}/{scratch}")
    return spark.read.schema(alerts.schema).parquet(f"{folder}/out")
