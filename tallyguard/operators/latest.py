"""Copies and versions: first copy of an event, last version of a fact.

Both are min/max aggregations, so each task reduces a group before the shuffle
and a group of any size arrives as at most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_copies(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, ``event_id``): the earliest, ties by the remaining columns."""
    group = [*keys, "event_id"]
    rest = ["event_time_ms", *sorted(c for c in events.columns if c not in (*group, "event_time_ms"))]
    kept = events.groupBy(*group).agg(F.min(F.struct(*rest)).alias("first"))
    return kept.select(*group, "first.*")


def last_versions(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the version with the greatest (``event_time_ms``, ``event_id``)."""
    rest = ["event_time_ms", "event_id"]
    rest += sorted(c for c in events.columns if c not in (*keys, *rest))
    kept = events.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("last"))
    return kept.select(*keys, "last.*")
