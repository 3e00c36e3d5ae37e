"""Late rows beside the alerts: counted, and kept where the rules could not use them.

A micro-batch carries the alerts and, in a second column, every valid event; the sink keeps the
events at or behind the watermark, which it learns from the query's offset log. Late rows up to the
allowance are used by the rules (``dropped`` is false); those behind the state's watermark are what
Spark's state operators refuse (``dropped`` is true).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.operators.validate import unchecked_events, union_events

ALERT, LATE = "alert", "late"


def beside_alerts(alerts: DataFrame, raw: dict[str, DataFrame]) -> DataFrame:
    """Alerts and all valid events in one stream: two structs, one of them null in each row.

    The topics are read once more for this, as for a quarantine; nothing is shuffled for it.
    """
    events = union_events(*[unchecked_events(stream, topic) for topic, stream in raw.items()])
    alert = alerts.select(F.struct(*alerts.columns).alias(ALERT))
    event = events.select(F.struct(*events.columns).alias(LATE))
    return alert.unionByName(event, allowMissingColumns=True)


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark a micro-batch started with, in milliseconds; 0 before the first."""
    if batch_id < 0:
        return 0
    # Version, settings of the batch, then one line per source.
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id}", wholetext=True).first()["value"]
    return json.loads(lines.splitlines()[1])["batchWatermarkMs"]


def late_only(batch: DataFrame, checkpoint: str, batch_id: int, allowance_ms: int) -> DataFrame:
    """The batch without events in time; late ones get ``dropped``.

    State operators refuse what is behind the watermark of the batch before, while rows are late
    by the present one.
    """
    spark = batch.sparkSession
    refused, present = (batch_watermark(spark, checkpoint, n) for n in (batch_id - 1, batch_id))
    behind = present + allowance_ms if present > 0 else 0
    at = F.col(f"{LATE}.event_time_ms")
    kept = batch.filter(F.col(ALERT).isNotNull() | (at <= max(behind, refused)))
    return kept.withColumn("dropped", at <= refused)
