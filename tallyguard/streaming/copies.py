"""Copies of events by slice: the first one passes, whatever the size of a micro-batch.

Spark's operator for this looks each event up in the state store, writes it there and removes it again, so
state, snapshots and time grow by a row per event. Here a slice holds the keys of its events as columns, and a
micro-batch reads and writes each slice once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Row

from tallyguard.streaming.slices import SliceState, event_ts, numbers, pieces


def distinct_rows(table: pa.Table) -> pa.Table:
    return table.group_by(table.column_names, use_threads=False).aggregate([])


class FirstCopies(SliceState):
    """Of rows with equal keys the first one, while its event time is less than ``delay_ms`` behind the watermark.

    As ``dropDuplicatesWithinWatermark`` does, but that rows are late by the present watermark instead of that of
    the micro-batch before, and that the earliest of the copies in a micro-batch is the first one. Late rows
    are dropped and counted, since their first copies may be forgotten.
    """

    def __init__(self, keys: list[str], delay_ms: int):
        self.keys = keys
        self.delay_ms = delay_ms

    def _keep(self, table: pa.Table, pending: int | None) -> None:
        times = numbers(table, "event_time_ms")
        self.keep(table, pending, times.min() + self.delay_ms if len(times) else None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pending, old = self.load()
        new = self.arrived(rows)
        watermark = timerValues.getCurrentWatermarkInMs()
        times = numbers(new, "event_time_ms")
        order = np.argsort(times, kind="stable")
        if watermark > 0:
            order = order[times[order] > watermark]
        late = new.num_rows - len(order)
        new = new.take(pa.array(order))
        seen = new.select([*self.keys, "event_time_ms"])
        known = 0 if old is None else old.num_rows
        both = seen if old is None else pa.concat_tables([old, seen])
        places = both.select(self.keys).append_column("_at", pa.array(np.arange(both.num_rows)))
        firsts = places.group_by(self.keys, use_threads=False).aggregate([("_at", "min")])
        at = np.sort(numbers(firsts, "_at_min"))
        # Keys that are near each other have much in common, which makes the state small.
        kept = both.take(pa.array(at)).combine_chunks()
        near = [numbers(kept, name) for name in self.keys if pa.types.is_integer(kept.schema.field(name).type)]
        self._keep(kept.take(pa.array(np.lexsort(near[::-1]))) if near else kept, pending)

        at = at[at >= known] - known
        reached = event_ts(max(times.max(), watermark + 1))
        if late and not len(at):
            yield Row(rows=None, late=late, event_ts=reached)
        for piece in pieces(new.take(pa.array(at))):
            yield Row(rows=piece, late=late, event_ts=reached)
            late = 0

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        pending, table = self.load()
        if table is not None:
            now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            self._keep(table.filter(pa.array(numbers(table, "event_time_ms") + self.delay_ms > now)), None)
        return iter(())
