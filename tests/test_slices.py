"""State in slices: as many state rows as slices, whatever the number of keys; windows judged as key by key."""

import random
from collections import defaultdict
from decimal import Decimal

import pyarrow as pa
import pytest
from conftest import detail, order, payment
from test_stream import Job, batch_ids, clock, closing

from tallyguard import contracts as C
from tallyguard.config import OrderParams, UserParams, WindowRule
from tallyguard.streaming.order_stream import OrderJudge
from tallyguard.streaming.slices import SLICES, dealer, event_ts, from_bytes, slice_numbers, to_bytes
from tallyguard.streaming.user_stream import FREE, PLACE, UserJudge, merged_places

KEYS = 4500


def state_rows(job):
    """The largest number of state rows of a processor in Python, its timers included."""
    operators = [op for p in job.progress for op in p["stateOperators"]]
    return max(op["numRowsTotal"] for op in operators if "transformWithState" in op["operatorName"])


def feed_once(spark, job_name, records, **options):
    job = Job(spark, job_name)
    job.rule_options = options
    job.feed(*records)
    rows = state_rows(job)
    job.feed(closing())
    expected = batch_ids(spark, job_name, records)
    assert len(expected) > 100
    assert job.ids() == expected and job.written() == len(expected)
    return rows


# Facts and orders had a state row and one or two timers each, and a Python call for each of these.
@pytest.mark.parametrize("immutable", [False, True])
def test_order_state_is_by_slice(spark, immutable):
    records = [order(i, i % 99, 10.0, clock(i % 600)) for i in range(KEYS)]
    records += [detail(i, i, 10.0 if i % 9 else 9.0, clock(i % 600)) for i in range(KEYS)]
    records += [payment(i, i, i % 99, 10.0 if i % 7 else 9.0, clock(i % 600 + i % 3 - 1)) for i in range(KEYS)]
    options = {"immutable_facts": True} if immutable else {}
    assert feed_once(spark, C.ORDER_JOB, records, **options) <= 4 * SLICES < KEYS


def test_user_state_is_by_slice(spark):
    records = [payment(i, i, i % 1500, 1.0, clock(i % 300), ok=False) for i in range(KEYS)]
    assert feed_once(spark, C.USER_JOB, records) <= 4 * SLICES < KEYS


class Value:
    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Handle:
    """State and timers of one slice."""

    def __init__(self):
        self.timers, self.value = set(), Value()

    def getValueState(self, name, schema):
        return self.value

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


class Rows:
    def __init__(self, table):
        self.rows = to_bytes(table)


def place_table(rows):
    columns = list(zip(*rows))
    types = [pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table({n: pa.array(c, t) for n, c, t in zip([*PLACE, "number"], columns, types)})


def test_windows_are_judged_as_key_by_key():
    params = UserParams(
        WindowRule(60, 10, 20, 50, 2, True), WindowRule(90, 30, 0, 60, 2, False), ttl_ms=100, block_slots=16
    )
    allowance, rules = 100, [params.unpaid, params.failure]
    rng = random.Random(7)
    for _ in range(25):
        judge, handle = UserJudge(params, allowance), Handle()
        judge.init(handle)
        places, judged, free = defaultdict(int), set(), {}
        watermark, got, expected = 1000, [], []
        for _ in range(30):
            rows = []
            for _ in range(rng.randrange(0, 8)):
                code = rng.randrange(2)
                rule = rules[code]
                time = watermark + rng.randrange(1, 250)
                slots = rule.windows if rng.random() < 0.7 else rng.randrange(1, rule.windows + 1)
                rows.append((rng.randrange(3), code, time // rule.slide_ms + 1, slots, rng.choice([1, 1, 1, 2, -1])))
            if rows:
                list(judge.handleInputRows((0,), iter([Rows(place_table(rows))]), At(watermark)))
                for *place, number in rows:
                    places[tuple(place)] += number
            # As in Spark, what is due fires after the rows; one timer of a slice is pending at most.
            assert len(handle.timers) <= 1
            for at in [t for t in handle.timers if t <= watermark]:
                for row in judge.handleExpiredTimer((0,), At(watermark), At(at)):
                    found = from_bytes(row.rows).to_pydict()
                    codes = [judge.codes.index(code) for code in found["code"]]
                    got += list(zip(found["user_id"], codes, found["window_end_ms"], found["count"]))
                handle.timers.discard(at)
            windows = {(u, c, s) for (u, c, f, n), number in places.items() if number for s in range(f, f + n)}
            for user, code, slot in sorted(windows - judged):
                rule = rules[code]
                if slot * rule.slide_ms + rule.wait_ms - allowance <= watermark:
                    judged.add((user, code, slot))
                    held = [n for (u, c, f, k), n in places.items() if (u, c) == (user, code) and f <= slot < f + k]
                    if sum(held) >= rule.min_count and slot >= free.get((user, code), slot):
                        free[user, code] = slot + rule.cooldown_slots
                        expected.append((user, code, slot * rule.slide_ms, sum(held)))
            watermark += rng.randrange(0, 60)
        assert got == expected and len(got) > 3


def test_released_state_leaves_nothing():
    params = UserParams(
        WindowRule(60, 10, 20, 50, 2, True), WindowRule(90, 30, 0, 60, 2, False), ttl_ms=100, block_slots=16
    )
    judge, handle = UserJudge(params, 100), Handle()
    judge.init(handle)
    list(judge.handleInputRows((0,), iter([Rows(place_table([(1, 1, 40, 3, 2)]))]), At(1000)))
    assert handle.value.value is not None
    fired = 0
    while handle.timers:
        at = handle.timers.pop()
        fired += len(list(judge.handleExpiredTimer((0,), At(at), At(at))))
        kinds = [] if handle.value.value is None else from_bytes(handle.value.value[1])["kind"].to_pylist()
        assert handle.timers or not kinds
        assert FREE in kinds or not handle.timers
    # Slots 40 and, after the cooldown, 42.
    assert fired == 2 and handle.value.value is None


def changes(*rows):
    """Rows (order, change, fact, amount, number, time); the event time is the time."""
    names = ["order_id", "change", "fact_id", "amount", "number", "time_ms"]
    columns = dict(zip(names, (list(c) for c in zip(*rows))))
    money, long = pa.decimal128(20, 2), pa.int64()
    types = [long, pa.string(), long, money, long, long]
    table = pa.table({n: pa.array(columns[n], t) for n, t in zip(names, types)})
    for name in ("user_id", "shop_id", "event_time_ms"):
        table = table.append_column(name, table["time_ms"])
    return table


def test_orders_of_a_slice_are_judged_apart():
    params = OrderParams(wait_ms=10, ttl_ms=100, disorder_ms=0)
    judge, handle = OrderJudge(params, 100), Handle()
    judge.init(handle)
    one, two = Decimal("1.00"), Decimal("2.00")

    def fire(watermark):
        found = []
        for at in sorted(t for t in handle.timers if t <= watermark):
            for row in judge.handleExpiredTimer((0,), At(watermark), At(at)):
                found += from_bytes(row.rows).to_pylist()
            handle.timers.discard(at)
        assert len(handle.timers) <= 1
        keys = ("order_id", "payment_id", "order_amount", "detail_amount", "detail_count", "payment_amount")
        return [tuple(r[k] for k in keys) for r in found]

    def feed(watermark, *rows):
        list(judge.handleInputRows((0,), iter([Rows(changes(*rows))]), At(watermark)))
        return fire(watermark)

    first = [(1, "order", 0, two, 1, 1000), (1, "detail", 7, one, 1, 1001), (1, "success", 5, one, 0, 1005)]
    other = [(1, "success", 4, two, 0, 1006), (2, "success", 9, one, 0, 1000), (3, "success", 6, one, 0, 1000)]
    assert feed(0, *first, *other) == []
    # Lines add up over batches; order 3's success is revoked, order 2 has neither order nor lines.
    assert feed(905, (1, "detail", 8, one, 1, 1002), (3, "revoked", 6, one, 0, 1007)) == []
    assert fire(915) == [(1, 5, two, Decimal("2.00"), 2, one), (2, 9, None, Decimal("0.00"), 0, one)]
    # A second success of a judged order raises nothing; order 3 may still be paid.
    assert feed(920, (1, "success", 12, two, 0, 1030), (3, "success", 6, two, 0, 1031)) == []
    assert fire(941) == [(3, 6, None, Decimal("0.00"), 0, two)]
    # Order 1 lives until 1030 + 100 - 100, and nothing stays after the last one.
    assert set(from_bytes(handle.value.value[1])["order_id"].to_pylist()) == {1, 2, 3}
    assert fire(1000) == [] and set(from_bytes(handle.value.value[1])["order_id"].to_pylist()) == {1, 3}
    assert fire(1031) == [] and handle.value.value is None and not handle.timers


def test_a_hot_user_reaches_the_judge_as_few_rows():
    rows = [(1, 1, slot % 20, 18, 1) for slot in range(60_000)] + [(2, 1, 5, 18, n) for n in (1, -1)]
    packed = pa.RecordBatch.from_pydict({"rows": [to_bytes(place_table(rows))]})
    dealt = list(dealer(["user_id"], SLICES, merged_places, packed=True)(iter([packed, packed])))
    found = [from_bytes(row.as_buffer()) for batch in dealt for row in batch.column("rows")]
    assert sum(table.num_rows for table in found) == 20
    assert {n for table in found for n in table["number"].to_pylist()} == {6000}


def test_keys_spread_over_slices():
    import numpy as np

    for step in (1, 100, 1024, 100_000):
        counts = np.bincount(slice_numbers([np.arange(100 * SLICES) * step], SLICES), minlength=SLICES)
        assert counts.min() > 30 and counts.max() < 200, step
    assert event_ts(1_700_000_000_123).timestamp() == 1_700_000_000.123
