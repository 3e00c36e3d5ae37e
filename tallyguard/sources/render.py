"""Unified events back to the topics' JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.contracts import PAYLOAD_TIME, TOPIC_EVENT_TYPES, TOPIC_SCHEMAS
from tallyguard.functions.times import time_text


def topic_columns(topic: str) -> dict[str, Column]:
    """The topic's JSON fields as expressions over unified events."""
    columns = {}
    for name in TOPIC_SCHEMAS[topic].names:
        if name == "event_time":
            columns[name] = time_text(F.col("event_time_ms"))
        elif name == PAYLOAD_TIME[topic]:
            columns[name] = time_text(F.col(f"{name}_ms"))
        else:
            columns[name] = F.col(name)
    return columns


def topic_json(events: DataFrame, topic: str) -> DataFrame:
    """The topic's events as one JSON text each."""
    fields = F.struct(*[c.alias(n) for n, c in topic_columns(topic).items()])
    mine = events.filter(F.col("event_type").isin(*TOPIC_EVENT_TYPES[topic]))
    return mine.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))
