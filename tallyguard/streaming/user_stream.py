"""The user rules on streams: facts, then window counts and cooldowns per user, both in slices of users."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallyguard.config import UserParams
from tallyguard.contracts import CODE_FAILURE
from tallyguard.operators.user_rules import user_alerts, user_facts
from tallyguard.streaming.facts import CODES, UserFact
from tallyguard.streaming.intake import Input, distinct_facts, with_late_count
from tallyguard.streaming.slices import (
    DEALT_SCHEMA,
    PIECE_SCHEMA,
    SLICES,
    SliceState,
    dealer,
    numbers,
    pieces,
    starts_of,
    unpack,
)

PLACE = ["user_id", "code", "first_slot", "slots"]
PICKED_SCHEMA = "user_id bigint, code string, window_end_ms bigint, count bigint"
# A place with its number of facts; a judged window; the first window that may alert again.
PLACED, JUDGED, FREE = 0, 1, 2


def merged_places(table: pa.Table) -> pa.Table:
    """Numbers of equal places added up; places of nothing are left out."""
    sums = table.group_by(PLACE, use_threads=False).aggregate([("number", "sum")])
    sums = sums.rename_columns([*PLACE, "number"]).select([*PLACE, "number"])
    return sums.filter(pa.array(numbers(sums, "number") != 0))


class UserJudge(SliceState):
    """Counts per place (first window slot, number of windows), judged window by window.

    The state holds numbers per slot, never events, so its size depends on the users and the
    retained time only. One timer is pending per slice; when it fires, all windows that are due
    are judged in ascending order, each at most once.
    """

    def __init__(self, params: UserParams, allowance_ms: int):
        self.rules = [params.unpaid, params.failure]
        self.slide, self.wait, self.windows, self.cooldown, self.least = (
            np.array([getattr(rule, name) for rule in self.rules])
            for name in ("slide_ms", "wait_ms", "windows", "cooldown_slots", "min_count")
        )
        self.codes = list(CODES)
        self.allowance_ms = allowance_ms

    def _timer(self, code: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return slot * self.slide[code] + self.wait[code] - self.allowance_ms

    def _end(self, code: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return slot * self.slide[code]

    def _load(self) -> tuple[int | None, list[tuple[np.ndarray, ...]]]:
        """The pending timer, and places, judged windows and cooldowns as columns."""
        pending, table = self.load()
        if table is None:
            return pending, [(np.zeros(0, np.int64),) * 5] * 3
        columns = [numbers(table, name).astype(np.int64) for name in [*PLACE, "number"]]
        kind = numbers(table, "kind")
        return pending, [tuple(c[kind == k] for c in columns) for k in (PLACED, JUDGED, FREE)]

    def _windows(self, places, judged):
        """Windows of places in ascending order: user, rule, slot, count, and whether they were not judged yet."""
        user, code, first, slots, number = places
        row = np.repeat(np.arange(len(user)), slots)
        slot = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(slots) - slots, slots)
        marks = len(judged[0])
        users, codes = np.concatenate([user[row], judged[0]]), np.concatenate([code[row], judged[1]])
        slot = np.concatenate([slot, judged[2]])
        count = np.concatenate([number[row], np.zeros(marks, np.int64)])
        is_mark = np.repeat([0, 1], [len(row), marks])
        order = np.lexsort((slot, codes, users))
        users, codes, slot, count, is_mark = (c[order] for c in (users, codes, slot, count, is_mark))
        starts = starts_of(users, codes, slot)
        if not len(starts):
            return users, codes, slot, count, is_mark == 0
        is_open = np.maximum.reduceat(is_mark, starts) == 0
        return users[starts], codes[starts], slot[starts], np.add.reduceat(count, starts), is_open

    def _store(self, places, judged, free, pending: int | None, watermark: int) -> None:
        """Keep what later rows can still refer to and set the next timer."""
        user, code, slot, _, is_open = self._windows(places, judged)
        user, code, slot = user[is_open], code[is_open], slot[is_open]
        # A place is kept while one of its windows is open: the next open one at or after its first.
        row = np.concatenate([np.arange(len(places[0])), np.full(len(user), -1)])
        users, codes = np.concatenate([places[0], user]), np.concatenate([places[1], code])
        slots = np.concatenate([places[2], slot])
        order = np.lexsort((row >= 0, -slots, codes, users))
        touched = np.zeros(len(places[0]), bool)
        if len(user):
            # Descending by slot within a rule, windows before places: the last window seen is the next one.
            seen = np.maximum.accumulate(np.where(row[order] < 0, np.arange(len(order)), -1))
            next_open = order[np.maximum(seen, 0)]
            same = (seen >= 0) & (users[next_open] == users[order]) & (codes[next_open] == codes[order])
            is_place = row[order] >= 0
            mine = row[order][is_place]
            touched[mine] = (same & (slots[next_open] < slots[order] + np.append(places[3], 0)[row[order]]))[is_place]
        recent = self._end(judged[1], judged[2] + self.windows[judged[1]]) > watermark
        resting = self._end(free[1], free[2]) > watermark
        kept = [(places, touched), (judged, recent), (free, resting)]
        columns = [np.concatenate([part[i][which] for part, which in kept]) for i in range(5)]
        kind = np.repeat([PLACED, JUDGED, FREE], [which.sum() for _, which in kept]).astype(np.int8)
        names = [*PLACE, "number"]
        table = pa.table({**dict(zip(names, columns)), "kind": kind})
        due = None
        if len(user):
            due = self._timer(code, slot).min()
        elif table.num_rows:
            # Nothing to judge: wake up once the marks and cooldowns are out of reach.
            ends = [self._end(judged[1], judged[2] + self.windows[judged[1]]), self._end(free[1], free[2])]
            due = np.concatenate([ends[0][recent], ends[1][resting]]).max()
        if due is None:
            table = table.slice(0, 0)
        self.keep(table, pending, due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pending, (places, judged, free) = self._load()
        new = self.arrived(rows)
        old = pa.table(dict(zip([*PLACE, "number"], places)))
        merged = merged_places(pa.concat_tables([old, new.cast(old.schema)]).combine_chunks())
        places = tuple(numbers(merged, name) for name in [*PLACE, "number"])
        self._store(places, judged, free, pending, timerValues.getCurrentWatermarkInMs())
        return iter(())

    def _picked(self, windows, free: dict[tuple[int, int], int]) -> Iterator[tuple[int, int, int, int]]:
        """Of windows that reach the threshold, ascending by user, rule and slot, those no cooldown covers."""
        for user, code, slot, count in zip(*(column.tolist() for column in windows)):
            if slot >= free.get((user, code), slot):
                free[user, code] = slot + int(self.cooldown[code])
                yield user, code, slot, count

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        pending, (places, judged, free) = self._load()
        if pending is None:
            return
        watermark = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        user, code, slot, count, is_open = self._windows(places, judged)
        due = is_open & (self._timer(code, slot) <= watermark)
        reached = due & (count >= self.least[code])
        until = dict(zip(zip(free[0].tolist(), free[1].tolist()), free[2].tolist()))
        picked = list(self._picked([column[reached] for column in (user, code, slot, count)], until))
        if picked:
            users, codes, slots, counts = (np.array(column, np.int64) for column in zip(*picked))
            rows = {
                "user_id": users,
                "code": pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int8)), self.codes).dictionary_decode(),
                "window_end_ms": self._end(codes, slots),
                "count": counts,
            }
            for piece in pieces(pa.table(rows)):
                yield Row(rows=piece)
        none = np.zeros(due.sum(), np.int64)
        marks = (user[due], code[due], slot[due], none, none)
        judged = tuple(np.concatenate(pair) for pair in zip(judged, marks))
        none = np.zeros(len(until), np.int64)
        columns = np.array([(u, c, s) for (u, c), s in until.items()], np.int64).reshape(-1, 3).T
        self._store(places, judged, (*columns, none, none), None, watermark)


def stream_picked_windows(events: DataFrame | list[Input], params: UserParams, allowance_ms: int | None = None) -> DataFrame:
    """Windows that raise an alert, as they are judged in event time."""
    allowance = params.ttl_ms if allowance_ms is None else allowance_ms
    facts = distinct_facts(events, user_facts, ["user_id"], params.disorder_ms, allowance)
    is_failure = (F.col("code") == CODE_FAILURE).cast("tinyint").alias("code")
    rows = facts.select("user_id", is_failure, "fact_id", "paid", "event_time_ms", "event_id", "time_ms")
    changes = (
        rows.mapInArrow(dealer(UserFact.keys[:3], SLICES), DEALT_SCHEMA)
        .groupBy("slice")
        .transformWithState(
            UserFact(params, allowance), PIECE_SCHEMA, "append", "eventTime", eventTimeColumnName="event_ts"
        )
    )
    counted = with_late_count(changes).filter("rows IS NOT NULL").select("rows")
    picked = (
        counted.mapInArrow(dealer(["user_id"], SLICES, merged_places, packed=True), DEALT_SCHEMA)
        .groupBy("slice")
        .transformWithState(UserJudge(params, allowance), "rows binary", "append", "eventTime")
    )
    return picked.mapInArrow(unpack, PICKED_SCHEMA)


def stream_user_alerts(
    events: DataFrame | list[Input], params: UserParams = UserParams(), allowance_ms: int | None = None
) -> DataFrame:
    return user_alerts(stream_picked_windows(events, params, allowance_ms), params)
