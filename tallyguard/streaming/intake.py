"""From raw topic streams to de-duplicated facts with a watermark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.operators.validate import union_events, valid_events
from tallyguard.streaming.copies import FirstCopies, distinct_rows
from tallyguard.streaming.silence import times_metric
from tallyguard.streaming.slices import DEALT_SCHEMA, PIECE_SCHEMA, SLICES, dealer

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_settings(shuffle_partitions: int | str) -> dict[str, str]:
    """What the stateful jobs need; the partition number is fixed for a checkpoint's life."""
    return {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        # Of several inputs the slowest one decides; silent ones are moved on by beats.
        "spark.sql.streaming.multipleWatermarkPolicy": "min",
    }


def state_session(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """A session of its own for a stateful job, so the caller's settings stay as they are."""
    session = spark.newSession()
    partitions = shuffle_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in state_settings(partitions).items():
        session.conf.set(key, value)
    return session


@dataclass(frozen=True)
class Input:
    """One topic's valid events, and beats (``event_time_ms``): times it is taken to have reached in silence."""

    events: DataFrame
    beats: DataFrame | None = None


def stream_events(raw: dict[str, DataFrame], strict: bool = True) -> DataFrame:
    """Valid events of all topics in one stream.

    The topics are united before the watermark: with one watermark an idle topic does
    not hold the others back, and one that lags by more than the delay loses rows.
    """
    return union_events(*[valid_events(stream, topic, strict) for topic, stream in raw.items()])


def topic_inputs(
    raw: dict[str, DataFrame], strict: bool = True, beats: dict[str, DataFrame] | None = None
) -> list[Input]:
    """Valid events per topic, each to have a watermark of its own; the slowest topic decides.

    The newest event time of a micro-batch is reported per topic, from which ``IdleWatch``
    writes the beats of silent topics.
    """
    inputs = []
    for topic, stream in raw.items():
        events = valid_events(stream, topic, strict)
        timed = events.observe(times_metric(topic), F.max("event_time_ms").alias("newest_ms"))
        inputs.append(Input(timed, (beats or {}).get(topic)))
    return inputs


def _distinct(batches):
    """Each Arrow batch without repeated rows."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if table.num_rows > 1:
            table = table.group_by(table.column_names, use_threads=False).aggregate([])
        yield from table.to_batches()


def _timed(facts: DataFrame, beats: DataFrame | None, delay_ms: int) -> DataFrame:
    if beats is not None:
        facts = facts.unionByName(beats.select("event_time_ms"), allowMissingColumns=True)
    timed = facts.withColumn("event_ts", F.timestamp_millis("event_time_ms"))
    return timed.withWatermark("event_ts", f"{delay_ms} milliseconds")


def _timed_facts(
    events: DataFrame | list[Input], to_facts: Callable[[DataFrame], DataFrame], delay_ms: int
) -> DataFrame:
    inputs = [Input(events)] if isinstance(events, DataFrame) else events
    parts = [_timed(to_facts(one.events), one.beats, delay_ms) for one in inputs]
    timed = reduce(DataFrame.unionByName, parts)
    if any(one.beats is not None for one in inputs):
        # Beats end here. The condition reads the event time, since Spark would move any
        # other below the watermark, which would then never see them.
        limit = F.when(F.col("event_id").isNull(), F.lit(2**62)).otherwise(F.lit(-(2**62)))
        timed = timed.filter(F.unix_millis("event_ts") >= limit)
    return timed


def distinct_facts(
    events: DataFrame | list[Input],
    to_facts: Callable[[DataFrame], DataFrame],
    keys: list[str],
    disorder_ms: int,
    allowance_ms: int,
    by_event: bool = True,
) -> DataFrame:
    """Facts with an event-time column, one per (keys, ``event_id``) within the watermark,
    or one per ``keys`` alone. United events get one watermark, a list of inputs one each.

    Copies that arrive together are dropped per Arrow batch before the shuffle, so an
    event sent a million times does not end up in one task. The watermark trails the
    newest event by the disorder plus an allowance: Spark drops rows behind the
    watermark, while the rules still use rows that are late by up to the allowance.
    The state timers are shifted by the allowance in turn, so nothing is judged later.
    """

    def merged(part: DataFrame) -> DataFrame:
        facts = to_facts(part)
        return facts.mapInArrow(_distinct, facts.schema)

    timed = _timed_facts(events, merged, disorder_ms + allowance_ms)
    return timed.dropDuplicatesWithinWatermark([*keys, "event_id"] if by_event else keys)


def distinct_pieces(
    events: DataFrame | list[Input],
    to_facts: Callable[[DataFrame], DataFrame],
    keys: list[str],
    columns: list[str],
    disorder_ms: int,
    allowance_ms: int,
) -> DataFrame:
    """The ``columns`` of ``distinct_facts``, one row per ``keys``, duplicates found by slice; in bytes (``rows``).

    For micro-batches that hold whole tables: neither state nor shuffles have a row per event. Copies that arrive
    together are dropped before the shuffle. Late rows are dropped by ``FirstCopies`` and counted in the
    observed metric ``dropped_events``.
    """
    delay = disorder_ms + allowance_ms
    timed = _timed_facts(events, to_facts, delay)
    rows = timed.select(*columns, F.xxhash64(*keys).alias("_copy"))
    firsts = (
        rows.mapInArrow(dealer(["_copy"], SLICES, distinct_rows, spent=("_copy",)), DEALT_SCHEMA)
        .groupBy("slice")
        .transformWithState(
            FirstCopies(keys, delay), PIECE_SCHEMA, "append", "eventTime", eventTimeColumnName="event_ts"
        )
    )
    counted = firsts.observe("dropped", F.sum("late").alias("dropped_events"))
    return counted.filter("rows IS NOT NULL").select("rows")


def with_late_count(changes: DataFrame) -> DataFrame:
    """Report the sum of ``late`` under the metric ``late_events`` of the query's progress."""
    return changes.observe("late", F.sum("late").alias("late_events"))
