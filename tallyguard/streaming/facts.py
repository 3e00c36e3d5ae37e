"""State per fact: an order, an order line or a payment attempt.

A fact's rows are few, so these processors hold the last version of each fact of a slice and
emit what changed. Facts are dealt to slices by their whole key, so a key with a large share of
all events spreads over all tasks here; the changes are added up before they are
dealt to the order or user they belong to, and arrive reduced there.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row

from tallyguard.config import UserParams
from tallyguard.contracts import CODE_FAILURE, CODE_UNPAID
from tallyguard.streaming.slices import SliceState, event_ts, numbers, pieces, starts_of

CODES = [CODE_UNPAID, CODE_FAILURE]
ORDER, DETAIL, PAYMENT = 0, 1, 2


def version_order(table: pa.Table, keys: list[str], last: np.ndarray) -> np.ndarray:
    """Row numbers sorted by the keys, then by version (event time, event id), then by ``last``."""
    columns = [numbers(table, key) for key in keys]
    at = numbers(table, "event_time_ms")
    order = np.lexsort((last, at, *reversed(columns)))
    same = at[order][1:] == at[order][:-1]
    for column in columns:
        same &= column[order][1:] == column[order][:-1]
    if same.any():
        # Only then do event ids decide; texts are slow to sort.
        names = [*keys, "event_time_ms", "event_id", "_last"]
        sortable = table.select(names[:-1]).append_column("_last", pa.array(last.astype(np.int8)))
        order = pc.sort_indices(sortable, [(name, "ascending") for name in names]).to_numpy()
    return order


class _FactState(SliceState):
    """Common part: a fact expires ``ttl_ms`` after its newest event."""

    def __init__(self, ttl_ms: int, allowance_ms: int):
        self.ttl_ms = ttl_ms
        self.allowance_ms = allowance_ms

    def late(self, times: np.ndarray, timer_values) -> int:
        """Rows at or behind the judging watermark; none is before the first watermark."""
        watermark = timer_values.getCurrentWatermarkInMs()
        return int((times <= watermark + self.allowance_ms).sum()) if watermark > 0 else 0

    def keep_facts(self, table: pa.Table, pending: int | None) -> None:
        newest = numbers(table, "newest_ms")
        self.keep(table, pending, newest.min() + self.ttl_ms - self.allowance_ms if len(newest) else None)

    def with_state(self, new: pa.Table, old: pa.Table | None) -> tuple[pa.Table, np.ndarray]:
        """State and new rows in one table, and which of them are state."""
        new = new.append_column("newest_ms", new["event_time_ms"])
        table = new if old is None else pa.concat_tables([new, old], promote_options="default")
        return table.combine_chunks(), np.arange(table.num_rows) >= new.num_rows

    def changed(self, changes: pa.Table, times: np.ndarray, late: int) -> Iterator[Row]:
        """Changes in bytes; the count of late rows goes with the first."""
        if late and not changes.num_rows:
            yield Row(rows=None, late=late, event_ts=event_ts(times.max()))
        for rows in pieces(changes):
            yield Row(rows=rows, late=late, event_ts=event_ts(times.max()))
            late = 0

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        pending, facts = self.load()
        if facts is not None:
            live = numbers(facts, "newest_ms") + self.ttl_ms - self.allowance_ms
            now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            self.keep_facts(facts.filter(pa.array(live > now)), None)
        return iter(())


class OrderFact(_FactState):
    """Last version of each fact of an order, by (event time, event id)."""

    keys = ["order_id", "kind", "fact_id"]
    kept = [*keys, "event_time_ms", "event_id", "success", "amount", "newest_ms"]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pending, old = self.load()
        new = self.arrived(rows)
        times = numbers(new, "event_time_ms")
        table, is_old = self.with_state(new, old)
        # Of equal versions the state's is the last one, so that nothing changes.
        order = version_order(table, self.keys, is_old)
        table, is_old = table.take(pa.array(order)), is_old[order]
        starts = starts_of(*[numbers(table, name) for name in self.keys])
        last = np.append(starts[1:], len(is_old)) - 1
        newest = np.maximum.reduceat(numbers(table, "newest_ms"), starts)
        before = np.maximum.reduceat(np.where(is_old, np.arange(len(is_old)), -1), starts)
        facts = table.take(pa.array(last))
        facts = facts.set_column(facts.schema.get_field_index("newest_ms"), "newest_ms", pa.array(newest))
        self.keep_facts(facts.select(self.kept), pending)

        known, newer = before >= 0, ~is_old[last]
        kind, success = numbers(facts, "kind"), numbers(facts, "success").astype(bool)
        was = numbers(table, "success").astype(bool)[np.maximum(before, 0)] & known
        names = ["order", "detail", "success", "revoked"]
        change = np.where(kind != PAYMENT, kind, np.where(success, 2, 3)).astype(np.int8)
        emitted = np.flatnonzero(newer & ((kind != PAYMENT) | success | was))
        facts, change = facts.take(pa.array(emitted)), change[emitted]
        replaced = known[emitted] & (change == DETAIL)
        earlier = table["amount"].take(pa.array(before[emitted], mask=~replaced))
        kind_of = facts["amount"].type
        difference = pc.subtract(facts["amount"], pc.fill_null(earlier, pa.scalar(Decimal("0.00"), kind_of)))
        columns = {
            "order_id": facts["order_id"],
            "change": pa.DictionaryArray.from_arrays(pa.array(change), names).dictionary_decode(),
            "fact_id": facts["fact_id"],
            "amount": difference.cast(kind_of),
            "number": pa.array(((change == DETAIL) & ~replaced).astype(np.int64)),
            **{name: facts[name] for name in ("time_ms", "user_id", "shop_id", "event_time_ms")},
        }
        return self.changed(pa.table(columns), times, self.late(times, timerValues))


class UserFact(_FactState):
    """Orders with their first payment, and failed payments, as the windows they count in.

    The state has up to two rows per fact: its last version, and its first payment.
    """

    keys = ["user_id", "code", "fact_id", "paid"]
    kept = [*keys, "event_time_ms", "event_id", "time_ms", "newest_ms"]

    def __init__(self, params: UserParams, allowance_ms: int):
        super().__init__(params.ttl_ms, allowance_ms)
        rules = [params.unpaid, params.failure]
        self.slide, self.wait, self.windows = (
            np.array([getattr(rule, name) for rule in rules]) for name in ("slide_ms", "wait_ms", "windows")
        )

    def merged(self, table: pa.Table, is_old: np.ndarray) -> pa.Table:
        """The last version and the first payment of each fact, with the fact's newest event time."""
        table = table.take(pa.array(version_order(table, self.keys, is_old)))
        columns = [numbers(table, name) for name in self.keys]
        starts = starts_of(*columns)
        first_paid = np.minimum.reduceat(numbers(table, "time_ms"), starts)
        rows = table.take(pa.array(np.append(starts[1:], table.num_rows) - 1))
        time = np.where(numbers(rows, "paid").astype(bool), first_paid, numbers(rows, "time_ms"))
        facts = starts_of(*[column[starts] for column in columns[:3]])
        newest = np.maximum.reduceat(np.maximum.reduceat(numbers(table, "newest_ms"), starts), facts)
        newest = np.repeat(newest, np.diff(np.append(facts, len(starts))))
        for name, values in (("time_ms", time), ("newest_ms", newest)):
            rows = rows.set_column(rows.schema.get_field_index(name), name, pa.array(values))
        return rows.select(self.kept)

    def placed(self, rows: pa.Table) -> tuple[np.ndarray, ...]:
        """Facts with a version: user, rule, fact, first window slot and number of windows; the batch plan
        has the same in columns."""
        user, code, fact, paid, time = (numbers(rows, name) for name in [*self.keys, "time_ms"])
        # A fact's version comes before its payment.
        versions = np.flatnonzero(paid == 0)
        after = np.minimum(versions + 1, len(paid) - 1)
        is_paid = paid[after] != 0
        for column in (user, code, fact):
            is_paid &= column[after] == column[versions]
        user, code, fact = user[versions], code[versions].astype(np.int64), fact[versions]
        slide, windows = self.slide[code], self.windows[code]
        first = time[versions] // slide + 1
        open_ms = time[after] - self.wait[code] - first * slide
        return user, code, fact, first, np.where(is_paid, np.clip(-(-open_ms // slide), 0, windows), windows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pending, old = self.load()
        new = self.arrived(rows)
        times = numbers(new, "event_time_ms")
        table, is_old = self.with_state(new, old)
        facts = self.merged(table, is_old)
        self.keep_facts(facts, pending)
        after = self.placed(facts)
        before = self.placed(old) if old is not None else tuple(column[:0] for column in after)
        user, code, fact, first, slots = (np.concatenate(pair) for pair in zip(before, after))
        number = np.repeat([-1, 1], [len(before[0]), len(after[0])])
        # A place that stays cancels out.
        order = np.lexsort((slots, first, fact, code, user))
        user, code, fact, first, slots, number = (c[order] for c in (user, code, fact, first, slots, number))
        starts = starts_of(user, code, fact, first, slots)
        number = np.add.reduceat(number, starts) if len(starts) else number
        changed = starts[(number != 0) & (slots[starts] > 0)]
        columns = {
            "user_id": user[changed],
            "code": code[changed].astype(np.int8),
            "first_slot": first[changed],
            "slots": slots[changed].astype(np.int64),
            "number": number[(number != 0) & (slots[starts] > 0)].astype(np.int64),
        }
        return self.changed(pa.table(columns), times, self.late(times, timerValues))
