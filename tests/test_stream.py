"""Streams: samples, disorder, copies, late rows, idle topics, restarts; always against batch."""

import json
import os
import random
import tempfile
import uuid
from datetime import datetime, timedelta

import pytest
from conftest import (
    GOLDEN_ORDER_IDS,
    GOLDEN_USER_IDS,
    SAMPLE_DETAILS,
    SAMPLE_ORDERS,
    SAMPLE_PAYMENTS,
    detail,
    lines,
    order,
    payment,
)

from tallyguard import contracts as C
from tallyguard.config import JobConfig
from tallyguard.operators.validate import union_events, valid_events
from tallyguard.plans.order_alerts import judge_orders
from tallyguard.plans.user_alerts import judge_users
from tallyguard.sinks.alert_log import current_alerts, read_log
from tallyguard.streaming import run

TOPIC_OF = {
    "ORDER_CREATED": C.ORDER_TOPIC,
    "ORDER_DETAIL": C.DETAIL_TOPIC,
    "PAYMENT_SUCCESS": C.PAYMENT_TOPIC,
    "PAYMENT_FAILED": C.PAYMENT_TOPIC,
}


class Job:
    """One streaming job over folders of JSON lines; each ``feed`` is at least one micro-batch."""

    def __init__(self, spark, job):
        self.spark, self.job = spark, job
        self.folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        for topic in C.TOPIC_SCHEMAS:
            os.makedirs(f"{self.folder}/in/{topic}")
        self.config = JobConfig(
            job, f"{self.folder}/checkpoint", None, None, None, None, shuffle_partitions=2, sink_retries=0
        )
        self.query = None
        self.progress = []
        self.rule_options = {}

    def feed(self, *records):
        by_topic = {}
        for record in records:
            by_topic.setdefault(TOPIC_OF[record["event_type"]], []).append(record)
        for topic, rows in by_topic.items():
            name = uuid.uuid4().hex
            with open(f"{self.folder}/in/{topic}/.{name}", "w") as out:
                out.write("\n".join(json.dumps(r) for r in rows) + "\n")
            os.rename(f"{self.folder}/in/{topic}/.{name}", f"{self.folder}/in/{topic}/{name}.json")
        self.query = run.start_job(
            self.spark,
            self.job,
            self.config,
            alert_path=f"{self.folder}/alerts",
            lines_path=f"{self.folder}/in",
            available_now=True,
            **self.rule_options,
        )
        # A query per feed: every feed is also a restart from the checkpoint.
        self.query.awaitTermination()
        self.progress += self.query.recentProgress
        return self

    def schema(self):
        return C.ORDER_ALERT_SCHEMA if self.job == C.ORDER_JOB else C.USER_ALERT_SCHEMA

    def alerts(self):
        return current_alerts(self.spark, f"{self.folder}/alerts", self.schema()).collect()

    def ids(self):
        return {r.alert_id for r in self.alerts()}

    def written(self):
        return read_log(self.spark, f"{self.folder}/alerts", self.schema()).count()

    def late(self):
        found = [p["observedMetrics"].get("late") for p in self.progress]
        return sum((row["late_events"] or 0) for row in found if row)


def batch_ids(spark, job, records):
    parts = []
    for topic in C.TOPIC_SCHEMAS:
        mine = [r for r in records if TOPIC_OF[r["event_type"]] == topic]
        if mine:
            parts.append(valid_events(lines(spark, mine), topic))
    judge = judge_orders if job == C.ORDER_JOB else judge_users
    return {r.alert_id for r in judge(union_events(*parts)).collect()}


def clock(seconds):
    text = datetime(2026, 8, 25, 10) + timedelta(seconds=seconds)
    return text.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]


def closing(seconds=40_000):
    return payment(9_999_999, 9_999_999, 9_999_999, 1.0, clock(seconds), ok=False)


def test_samples_as_a_stream(spark):
    samples = SAMPLE_ORDERS + SAMPLE_DETAILS + SAMPLE_PAYMENTS
    orders = Job(spark, C.ORDER_JOB).feed(*samples)
    assert orders.ids() == set(GOLDEN_ORDER_IDS)
    # The same facts again: no new alert.
    assert orders.feed(*samples).written() == 4
    users = Job(spark, C.USER_JOB).feed(*samples)
    assert users.ids() == set(GOLDEN_USER_IDS)


def test_order_stream_equals_batch_under_disorder_and_copies(spark):
    rng = random.Random(3)
    records = []
    for i in range(1, 40):
        start = rng.randrange(0, 1200)
        if i % 7:
            records.append((start, order(i, i % 5, 10.0 * i, clock(start))))
        parts = rng.randrange(0, 4)
        for part in range(parts):
            time = start + rng.randrange(0, 60)
            amount = 10.0 * i / parts if i % 3 else 1.0
            records.append((time, detail(i * 10 + part, i, round(amount, 2), clock(time))))
        if i % 4:
            time = start + rng.randrange(-30, 100)
            records.append((time, payment(i, i, i % 5, 10.0 * i + (i % 2), clock(time), ok=i % 6 != 1)))
    # Arrival up to 90 s after the event time, every third event twice.
    arrivals = [(t + rng.randrange(0, 90), r) for t, r in records]
    arrivals += [(t + rng.randrange(0, 90), r) for t, r in records[::3]]
    arrivals.sort(key=lambda a: a[0])
    job = Job(spark, C.ORDER_JOB)
    third = len(arrivals) // 3
    for part in (arrivals[:third], arrivals[third : 2 * third], arrivals[2 * third :]):
        job.feed(*[r for _, r in part])
    job.feed(closing())
    expected = batch_ids(spark, C.ORDER_JOB, [r for _, r in records])
    assert len(expected) > 20
    assert job.ids() == expected and job.written() == len(expected)


def test_user_stream_equals_batch_under_disorder_and_copies(spark):
    rng = random.Random(5)
    records = []
    for i in range(1, 150):
        user = 1 if i % 2 else i % 5
        start = rng.randrange(0, 900)
        records.append((start, order(i, user, 5.0, clock(start))))
        if i % 4 == 0:
            time = start + rng.randrange(1, 300)
            records.append((time, payment(1000 + i, i, user, 5.0, clock(time))))
        if i % 5 == 0:
            time = rng.randrange(0, 900)
            records.append((time, payment(2000 + i, i, user, 5.0, clock(time), ok=False)))
    arrivals = [(t + rng.randrange(0, 90), r) for t, r in records]
    arrivals += [(t + rng.randrange(0, 90), r) for t, r in records[::4]]
    arrivals.sort(key=lambda a: a[0])
    job = Job(spark, C.USER_JOB)
    quarter = len(arrivals) // 4 + 1
    for i in range(4):
        job.feed(*[r for _, r in arrivals[i * quarter : (i + 1) * quarter]])
    job.feed(closing())
    expected = batch_ids(spark, C.USER_JOB, [r for _, r in records])
    assert len(expected) >= 5
    assert job.ids() == expected and job.written() == len(expected)


def test_late_rows_within_the_allowance_are_used_and_counted(spark):
    job = Job(spark, C.ORDER_JOB)
    job.feed(payment(1, 1, 1, 5.0, clock(0)), order(1, 1, 5.0, clock(0)))
    # The watermark passes 10:20; the line of 10:00:01 is late, the order's judgement is over.
    job.feed(payment(50, 50, 1, 5.0, clock(1400), ok=False))
    # Order 2 and its payment are both late but not judged yet: used.
    job.feed(order(2, 1, 5.0, clock(100)), detail(2, 2, 4.0, clock(101)), payment(2, 2, 1, 5.0, clock(102)))
    job.feed(closing())
    found = {(r.order_id, r.risk_item) for r in job.alerts()}
    assert found == {(1, "明细金额不一致"), (2, "明细金额不一致")}
    assert job.late() == 3


def test_idle_topic_does_not_hold_judgements_back(spark):
    job = Job(spark, C.ORDER_JOB).feed(payment(1, 1, 1, 5.0, clock(0)))
    job.feed(payment(2, 2, 1, 5.0, clock(241), ok=False))
    assert {r.risk_item for r in job.alerts()} == {"订单不存在"}


def test_pending_timer_survives_a_restart(spark):
    job = Job(spark, C.ORDER_JOB).feed(payment(1, 1, 1, 5.0, clock(0)), order(1, 1, 6.0, clock(0)))
    assert not os.path.exists(f"{job.folder}/alerts") or job.ids() == set()
    # Nothing judged before the wait and the watermark delay are over: 240 s.
    job.feed(payment(2, 2, 1, 5.0, clock(239), ok=False))
    assert job.written() == 0
    job.feed(payment(3, 2, 1, 5.0, clock(240), ok=False))
    assert {r.risk_item for r in job.alerts()} == {"明细金额不一致", "支付金额不一致"}


def test_versions_and_second_success_in_a_stream(spark):
    job = Job(spark, C.ORDER_JOB)
    job.feed(order(1, 1, 5.0, clock(0), "a"), detail(1, 1, 9.0, clock(1), "d1"))
    job.feed(order(1, 1, 7.0, clock(2), "b"), detail(1, 1, 7.0, clock(3), "d2"), detail(1, 1, 1.0, clock(2), "d0"))
    job.feed(payment(1, 1, 1, 7.0, clock(5)), payment(2, 2, 1, 7.0, clock(5), event_id="s"))
    # The attempt 2 turns into a failure: order 2 is not judged.
    job.feed(payment(2, 2, 1, 7.0, clock(6), ok=False, event_id="f"))
    job.feed(payment(3, 3, 3, 1.0, clock(300), ok=False))
    job.feed(payment(4, 1, 1, 99.0, clock(301)))
    job.feed(closing())
    assert job.ids() == set()


def test_success_of_another_user_does_not_clear_an_order(spark):
    base = [order(i, 1, 1.0, clock(i)) for i in range(6)]
    mine = Job(spark, C.USER_JOB).feed(*base, payment(1, 1, 1, 1.0, clock(9)), closing())
    assert mine.ids() == set()
    other = Job(spark, C.USER_JOB).feed(*base, payment(1, 1, 2, 1.0, clock(9)), closing())
    assert len(other.ids()) == 1


def test_late_failures_judge_open_windows_but_none_twice(spark):
    fail = lambda i, user, at: payment(i, i, user, 1.0, clock(at), ok=False)
    job = Job(spark, C.USER_JOB).feed(fail(1, 1, 0), fail(2, 1, 9))
    # Past the end of all windows of these two failures; within the allowance for late rows.
    job.feed(fail(3, 9, 500))
    job.feed(fail(4, 1, 5), *[fail(10 + i, 2, 5 + i) for i in range(3)])
    job.feed(closing())
    assert {(r.user_id, r.failed_payment_count) for r in job.alerts()} == {(2, 3)}
    assert job.late() == 4


def test_quarantine_stream_keeps_bad_texts(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for topic in C.TOPIC_SCHEMAS:
        os.makedirs(f"{folder}/in/{topic}")
    with open(f"{folder}/in/{C.ORDER_TOPIC}/a.json", "w") as out:
        out.write("nonsense\n" + json.dumps(SAMPLE_ORDERS[0]) + "\n")
    config = JobConfig(C.ORDER_JOB, f"{folder}/checkpoint/", None, None, None, None)
    query = run.start_quarantine(spark, C.ORDER_JOB, config, f"{folder}/bad", f"{folder}/in", available_now=True)
    query.awaitTermination()
    rows = spark.read.schema("topic string, value string, reasons array<string>").json(f"{folder}/bad").collect()
    assert [(r.topic, r.value, r.reasons) for r in rows] == [(C.ORDER_TOPIC, "nonsense", ["malformed_json"])]


def test_immutable_facts_give_the_samples_alerts(spark):
    job = Job(spark, C.ORDER_JOB)
    job.rule_options = {"immutable_facts": True}
    samples = SAMPLE_ORDERS + SAMPLE_DETAILS + SAMPLE_PAYMENTS
    assert job.feed(*samples).feed(*samples).ids() == set(GOLDEN_ORDER_IDS)
    assert job.written() == 4


def test_command_line(spark, monkeypatch):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    monkeypatch.setenv("CHECKPOINT_ROOT", f"{folder}/checkpoints")
    for topic, rows in (
        (C.ORDER_TOPIC, SAMPLE_ORDERS),
        (C.DETAIL_TOPIC, SAMPLE_DETAILS),
        (C.PAYMENT_TOPIC, SAMPLE_PAYMENTS),
    ):
        os.makedirs(f"{folder}/in/{topic}")
        with open(f"{folder}/in/{topic}/a.json", "w") as out:
            out.write("\n".join(json.dumps(r) for r in rows) + "\nnonsense\n")
    paths = ["--lines", f"{folder}/in", "--alerts", f"{folder}/alerts", "--quarantine", f"{folder}/bad"]
    run.main([C.USER_JOB, *paths, "--console", "--available-now"])
    found = current_alerts(spark, f"{folder}/alerts", C.USER_ALERT_SCHEMA).collect()
    assert {r.alert_id for r in found} == set(GOLDEN_USER_IDS)
    assert spark.read.text(f"{folder}/bad").count() == 2
    assert os.path.isdir(f"{folder}/checkpoints/user-risk")


def test_malformed_text_stops_a_strict_job(spark):
    job = Job(spark, C.ORDER_JOB)
    with open(f"{job.folder}/in/{C.ORDER_TOPIC}/bad.json", "w") as out:
        out.write('{"event_id": "x"}\n')
    with pytest.raises(Exception, match="missing:event_type"):
        job.feed(closing())


def test_processors_load_without_the_package():
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tallyguard.config import OrderParams, UserParams
    from tallyguard.streaming.facts import OrderFact, UserFact
    from tallyguard.streaming.intake import _distinct
    from tallyguard.streaming.order_stream import OrderJudge, merge_details
    from tallyguard.streaming.user_stream import UserJudge

    shipped = [OrderFact(1, 1), UserFact(UserParams(), 1), OrderJudge(OrderParams(), 1), UserJudge(UserParams(), 1)]
    data = cloudpickle.dumps([*shipped, merge_details, _distinct])
    check = "import sys, pickle; assert len(pickle.loads(sys.stdin.buffer.read())) == 6; assert 'tallyguard' not in sys.modules"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", check], input=data, cwd="/tmp", env=env, check=True, timeout=120)


def test_restarts_are_bounded():
    calls = []

    def start():
        calls.append(1)
        raise RuntimeError("down")

    with pytest.raises(RuntimeError):
        run.run_with_restarts(start, restarts=3, delay_seconds=0)
    assert len(calls) == 4


def test_bad_alert_is_refused(spark):
    from tallyguard.operators.checks import order_alert_checks

    good = judge_orders(
        union_events(valid_events(lines(spark, SAMPLE_PAYMENTS), C.PAYMENT_TOPIC))
    )
    assert run.accepted(good, order_alert_checks()).count() == 2
    with pytest.raises(Exception, match="detail_count"):
        run.accepted(good.withColumn("detail_count", -good.detail_count - 1), order_alert_checks()).collect()


def feed_files(folder, topic, *files):
    for number, rows in enumerate(files):
        with open(f"{folder}/in/{topic}/.{number}", "w") as out:
            out.write("\n".join(json.dumps(r) for r in rows) + "\n")
        os.rename(f"{folder}/in/{topic}/.{number}", f"{folder}/in/{topic}/{number}.json")
        os.utime(f"{folder}/in/{topic}/{number}.json", (1_700_000_000 + number,) * 2)


def running_job(spark, job, idle_seconds, **options):
    """A job that keeps running, a file of each topic per micro-batch, with a watermark per topic."""
    made = Job(spark, job)
    made.config = JobConfig(
        job, f"{made.folder}/checkpoint", None, None, None, None, shuffle_partitions=2, sink_retries=0,
        trigger_seconds=0, idle_seconds=idle_seconds,
    )

    def start():
        return run.start_job(
            spark, job, made.config, f"{made.folder}/alerts", f"{made.folder}/in", max_files=1, **options
        )

    return made, start


def test_topic_that_lags_three_hours_loses_no_row(spark):
    hour = 3600
    job, start = running_job(spark, C.ORDER_JOB, 3600)
    # Payments run ahead by three hours; orders and lines of the first payments come batches later.
    paid = [[payment(i, i, 1, 5.0, clock(i * hour + 60))] for i in range(4)]
    feed_files(job.folder, C.PAYMENT_TOPIC, *paid, [closing()])
    lagging = [[order(9, 9, 1.0, clock(0))]] * 4 + [[order(i, 1, 5.0, clock(i * hour))] for i in range(4)]
    feed_files(job.folder, C.ORDER_TOPIC, *lagging, [order(10, 9, 1.0, clock(40_000))])
    lines_of = [[detail(i, i, 5.0 if i else 4.0, clock(i * hour + 1))] for i in range(4)]
    feed_files(job.folder, C.DETAIL_TOPIC, *[[detail(90, 9, 1.0, clock(0))]] * 5, *lines_of, [detail(91, 9, 1.0, clock(40_000))])
    query = start()
    query.processAllAvailable()
    query.stop()
    # With one watermark the late orders would be missing; only the line of order 0 is wrong.
    assert [(r.order_id, r.risk_item) for r in job.alerts()] == [(0, "明细金额不一致")]
    assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 0
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 5


def test_silent_topics_hold_nothing_back(spark):
    import time

    job, start = running_job(spark, C.ORDER_JOB, 2)
    feed_files(job.folder, C.PAYMENT_TOPIC, [payment(1, 1, 1, 5.0, clock(0))], [closing()])
    query = start()
    # Orders and lines never come: at first nothing is judged, then the silence is noticed.
    until = time.time() + 90
    while time.time() < until and not (os.path.exists(f"{job.folder}/alerts") and job.written()):
        time.sleep(1)
    query.stop()
    assert {(r.order_id, r.risk_item) for r in job.alerts()} == {(1, "订单不存在")}


def test_silence():
    from tallyguard.streaming.silence import Silence

    quiet = Silence(["a", "b", "c"], 30, now=0)
    assert quiet.beats(100) == {}
    quiet.saw("a", 5000, 100)
    # b and c are silent since the start; a is not.
    assert quiet.beats(101) == {"b": 5000, "c": 5000} and quiet.beats(102) == {}
    quiet.saw("b", 3000, 110)
    quiet.saw("a", 9000, 120)
    # b is back and slower: c waits for it, and has been further before.
    assert quiet.beats(121) == {}
    # Only c and b silent: a decides. All silent: the newest event does.
    assert quiet.beats(145) == {"b": 9000, "c": 9000}
    quiet.saw("b", 12_000, 146)
    assert quiet.beats(160) == {"a": 12_000, "c": 12_000}
    assert quiet.beats(1000) == {}


@pytest.mark.parametrize("immutable", [False, True])
def test_late_events_are_counted_and_kept(spark, immutable):
    job = Job(spark, C.ORDER_JOB)
    job.rule_options = {"immutable_facts": immutable, "late_path": f"{job.folder}/late"}
    job.feed(payment(1, 1, 1, 5.0, clock(0)), order(1, 1, 5.0, clock(0)))
    job.feed(payment(50, 50, 1, 5.0, clock(18_000), ok=False))
    job.feed(payment(51, 51, 1, 5.0, clock(18_001), ok=False))
    # Five hours late: refused. One hour late: used. One in time.
    job.feed(order(2, 1, 5.0, clock(1)), payment(3, 3, 1, 5.0, clock(14_400)), order(4, 1, 1.0, clock(18_002)))
    job.feed(closing())
    kept = spark.read.json(f"{job.folder}/late").collect()
    assert {(r.event_id, r.dropped) for r in kept} == {("o:2", True), ("p:3", False)}
    dropped = sum(op["numRowsDroppedByWatermark"] for p in job.progress for op in p["stateOperators"])
    assert dropped == 1
    assert {(r.order_id, r.risk_item) for r in job.alerts()} >= {(3, "订单不存在")}
    assert not any(name.startswith("batch=") for name in os.listdir(f"{job.folder}/checkpoint-staged"))


def test_a_retry_writes_again_without_evaluating_again(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    evaluated = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    steps = []

    def write(rows, batch_id):
        steps.append(sorted(r.id for r in rows.collect()))
        if len(steps) == 1:
            raise RuntimeError("the table is away")

    rows = spark.range(5).mapInArrow(counted, "id bigint")
    run.staged_writer(write, f"{folder}/checkpoint", retries=1, delay_seconds=0)(rows, 7)
    assert steps == [[0, 1, 2, 3, 4]] * 2 and evaluated.value == 5
    assert os.listdir(f"{folder}/checkpoint-staged") == []
