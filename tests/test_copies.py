"""Duplicates by slice: as Spark's operator has it, without a state row per event."""

import random

import pyarrow as pa
import pytest
from conftest import detail, order, payment
from test_slices import KEYS, At, Handle, Rows, state_rows
from test_stream import Job, batch_ids, clock, closing

from tallyguard import contracts as C
from tallyguard.streaming.copies import FirstCopies
from tallyguard.streaming.slices import SLICES, from_bytes, to_bytes

DELAY = 100


def event_table(rows):
    order_id, event_id, at, value = (list(column) for column in zip(*rows))
    long = pa.int64()
    return pa.table(
        {
            "order_id": pa.array(order_id, long),
            "event_id": pa.array(event_id, pa.string()),
            "event_time_ms": pa.array(at, long),
            "value": pa.array(value, long),
        }
    )


def test_first_copies_as_key_by_key():
    rng = random.Random(3)
    for _ in range(20):
        copies, handle = FirstCopies(["order_id", "event_id"], DELAY), Handle()
        copies.init(handle)
        seen, watermark, number, late = {}, 0, 0, 0
        for _ in range(40):
            rows = []
            for _ in range(rng.randrange(0, 9)):
                number += 1
                at = max(1, watermark + rng.randrange(-20, 150))
                rows.append((rng.randrange(3), f"e:{rng.randrange(4)}", at, number))
            if rows:
                expected = []
                for order_id, event_id, at, value in sorted(rows, key=lambda r: r[2]):
                    if watermark and at <= watermark:
                        late += 1
                    elif (order_id, event_id) not in seen:
                        seen[order_id, event_id] = at
                        expected.append(value)
                found = list(copies.handleInputRows((0,), iter([Rows(event_table(rows))]), At(watermark)))
                late -= sum(row.late for row in found)
                passed = [v for row in found if row.rows for v in from_bytes(row.rows)["value"].to_pylist()]
                assert sorted(passed) == sorted(expected)
                # Spark refuses rows that a processor dates before the watermark.
                assert all(row.event_ts.timestamp() * 1000 > watermark for row in found)
            assert late == 0 and len(handle.timers) <= 1
            for at in [t for t in handle.timers if t <= watermark]:
                list(copies.handleExpiredTimer((0,), At(watermark), At(at)))
                handle.timers.discard(at)
            seen = {key: at for key, at in seen.items() if at + DELAY > watermark}
            held = handle.value.value
            assert (0 if held is None else from_bytes(held[1]).num_rows) == len(seen)
            watermark += rng.randrange(0, 60)


# Spark's operator had a state row for each event.
@pytest.mark.parametrize("immutable", [False, True])
def test_state_of_duplicates_is_by_slice(spark, immutable):
    records = [order(i, i % 99, 10.0, clock(i % 600)) for i in range(KEYS)]
    records += [detail(i, i, 10.0 if i % 9 else 9.0, clock(i % 600)) for i in range(KEYS)]
    records += [payment(i, i, i % 99, 10.0 if i % 7 else 9.0, clock(i % 600 + i % 3 - 1)) for i in range(KEYS)]
    job = Job(spark, C.ORDER_JOB)
    job.rule_options = {"by_slice": True, "immutable_facts": immutable}
    job.feed(*records)
    every = [op["numRowsTotal"] for p in job.progress for op in p["stateOperators"]]
    assert max(every) == state_rows(job) <= 4 * SLICES < KEYS
    # All of it once more, then the end.
    job.feed(*records, closing())
    expected = batch_ids(spark, C.ORDER_JOB, records)
    assert len(expected) > 100
    assert job.ids() == expected and job.written() == len(expected)


def test_versions_copies_and_late_rows_by_slice(spark):
    job = Job(spark, C.ORDER_JOB)
    job.rule_options = {"by_slice": True}
    job.feed(order(1, 1, 5.0, clock(0)), detail(1, 1, 4.0, clock(1)), payment(1, 1, 1, 5.0, clock(3)))
    # A copy of the first line does not bring its amount back after the second version; order 2 is refused.
    job.feed(detail(1, 1, 5.0, clock(2), event_id="d:1b"), detail(1, 1, 4.0, clock(2), event_id="d:1"))
    job.feed(payment(50, 50, 1, 5.0, clock(18_000), ok=False))
    job.feed(order(2, 1, 5.0, clock(1)), payment(3, 3, 1, 5.0, clock(14_400)), order(4, 1, 1.0, clock(18_002)))
    job.feed(closing())
    assert [(r.order_id, r.risk_item) for r in job.alerts()] == [(3, C.ORDER_MISSING)]
    counts = [p["observedMetrics"].get("dropped") for p in job.progress]
    assert sum((row["dropped_events"] or 0) for row in counts if row) == 1


@pytest.mark.parametrize("size", [0, 1, 5, 3000])
def test_bytes_of_a_table(size):
    texts = {
        "change": [[None, "detail", "order"][i % 3] for i in range(size)],
        "event_id": [f"order:{i}" for i in range(size)],
        "few_then_many": ["a" if i < size // 2 else str(i) for i in range(size)],
    }
    table = pa.table({name: pa.array(values, pa.string()) for name, values in texts.items()})
    times = pa.array([None if i % 7 == 0 else i * 86_400_000 for i in range(size)], pa.int64())
    table = table.append_column("time_ms", times).append_column("event_time_ms", times)
    again = from_bytes(to_bytes(table))
    assert again.schema == table.schema and again.equals(table)
    # Checkpoints of earlier code have Arrow streams compressed by column.
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table)
    earlier = sink.getvalue().to_pybytes()
    assert from_bytes(earlier).equals(table)
    if size == 3000:
        assert len(to_bytes(table)) < 0.6 * len(earlier)
