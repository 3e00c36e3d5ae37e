"""Topics that send nothing: how far the others may move the watermark without them.

With a watermark per topic the slowest one decides, so a topic that is silent would hold everything
back. Here a topic that showed no row for some seconds of processing time is given beats: rows that
carry an event time only. They are files read by the streaming query like any other input, so the
checkpoint records which beats a micro-batch had, and a batch that is run again sees the same ones.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

BEAT_SCHEMA = "event_time_ms bigint"


def times_metric(topic: str) -> str:
    """The observed metric with the newest event time of a topic in a micro-batch."""
    return f"{topic}_times"


class Silence:
    """Which topics are silent, and the event time each of them may be taken to have reached.

    That is the time of the slowest topic that is not silent, or of the newest event where all
    are. A topic without any row counts from the start of the job.
    """

    def __init__(self, topics: list[str], idle_seconds: float, now: float):
        self.idle_seconds = idle_seconds
        self.newest: dict[str, int | None] = dict.fromkeys(topics)
        self.seen = dict.fromkeys(topics, now)
        self.reached: dict[str, int] = {}

    def saw(self, topic: str, newest_ms: int, now: float) -> None:
        old = self.newest[topic]
        self.newest[topic] = newest_ms if old is None else max(old, newest_ms)
        self.seen[topic] = now

    def beats(self, now: float) -> dict[str, int]:
        """The beats to write; each is given once, and only if it moves its topic on."""
        silent = [t for t, at in self.seen.items() if now - at >= self.idle_seconds]
        active = [self.newest[t] for t in self.newest if t not in silent]
        known = [ms for ms in self.newest.values() if ms is not None]
        if not known or None in active:
            return {}
        target = min(active) if active else max(known)
        at = {t: max(self.newest[t] or 0, self.reached.get(t, 0)) for t in silent}
        due = {t: target for t in silent if at[t] < target}
        self.reached.update(due)
        return due


def beat_folders(spark: SparkSession, checkpoint: str, topics: list[str]) -> dict[str, str]:
    """A folder of beats per topic beside the checkpoint, there before the first beat."""
    folders = {topic: f"{checkpoint.rstrip('/')}-beats/{topic}" for topic in topics}
    for folder in folders.values():
        spark.createDataFrame([], BEAT_SCHEMA).write.mode("append").json(folder)
    return folders


def beat_streams(spark: SparkSession, folders: dict[str, str]) -> dict[str, DataFrame]:
    reader = spark.readStream.schema(BEAT_SCHEMA).option("cleanSource", "delete")
    return {topic: reader.json(folder) for topic, folder in folders.items()}


class IdleWatch(StreamingQueryListener):
    """Writes the beats of a query's silent topics, as its progress reports come in."""

    def __init__(
        self,
        spark: SparkSession,
        query_name: str,
        folders: dict[str, str],
        idle_seconds: float,
        clock: Callable[[], float] = time.monotonic,
    ):
        self.spark, self.query_name, self.folders, self.clock = spark, query_name, folders, clock
        self.silence = Silence(list(folders), idle_seconds, clock())

    def beat(self) -> None:
        for topic, target in self.silence.beats(self.clock()).items():
            self.spark.createDataFrame([(target,)], BEAT_SCHEMA).coalesce(1).write.mode("append").json(
                self.folders[topic]
            )

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name != self.query_name:
            return
        for topic in self.folders:
            row = event.progress.observedMetrics.get(times_metric(topic))
            if row is not None and row["newest_ms"] is not None:
                self.silence.saw(topic, row["newest_ms"], self.clock())
        self.beat()

    def onQueryIdle(self, event) -> None:
        # A session of a job has one query.
        self.beat()

    def onQueryTerminated(self, event) -> None:
        pass
