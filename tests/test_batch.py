"""The samples' alerts and the unit vectors, in batch."""

import hashlib
import random
from datetime import datetime
from decimal import Decimal
from zoneinfo import ZoneInfo

import pytest
from conftest import (
    DAY,
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
from pyspark.sql import functions as F

from tallyguard import contracts as C
from tallyguard.functions.ids import stable_number, user_alert_id
from tallyguard.functions.times import business_date, local_time, parse_millis, wall_clock_millis
from tallyguard.operators.order_rules import order_alerts
from tallyguard.operators.validate import union_events, valid_events
from tallyguard.operators.windows import window_ends
from tallyguard.plans.order_alerts import judge_orders
from tallyguard.plans.user_alerts import judge_users


def events_of(spark, orders=(), details=(), payments=()):
    parts = []
    for topic, records in ((C.ORDER_TOPIC, orders), (C.DETAIL_TOPIC, details), (C.PAYMENT_TOPIC, payments)):
        if records:
            parts.append(valid_events(lines(spark, records), topic))
    return union_events(*parts)


def test_sample_order_alerts(spark):
    rows = judge_orders(events_of(spark, SAMPLE_ORDERS, SAMPLE_DETAILS, SAMPLE_PAYMENTS)).collect()
    assert {r.alert_id: r.risk_item for r in rows} == GOLDEN_ORDER_IDS
    by_item = {r.risk_item: r for r in rows}
    early = by_item["支付早于下单"]
    assert (early.time_difference_seconds, early.difference_amount) == (5, None)
    assert (early.order_amount, early.detail_amount, early.payment_amount) == (
        Decimal("100.00"),
        Decimal("80.00"),
        Decimal("90.00"),
    )
    assert (early.user_id, early.shop_id, early.detail_count) == (2001, 301, 1)
    assert early.alert_time == datetime(2026, 8, 25, 10, 2, 5)
    assert str(early.alert_date) == "2026-08-25"
    assert by_item["明细金额不一致"].difference_amount == Decimal("20.00")
    assert by_item["支付金额不一致"].difference_amount == Decimal("10.00")
    missing = by_item["订单不存在"]
    assert (missing.order_id, missing.user_id, missing.shop_id, missing.order_amount) == (1002, None, None, None)
    assert (missing.detail_amount, missing.detail_count) == (Decimal("0.00"), 0)
    assert early.risk_reason == "支付时间早于订单创建时间 5 秒"
    assert by_item["明细金额不一致"].risk_reason == "订单明细金额合计与订单金额不一致，差额为 20.00 元"


def test_sample_user_alerts(spark):
    rows = judge_users(events_of(spark, SAMPLE_ORDERS, SAMPLE_DETAILS, SAMPLE_PAYMENTS)).collect()
    assert {r.alert_id: r.alert_type for r in rows} == GOLDEN_USER_IDS
    by_type = {r.alert_type: r for r in rows}
    unpaid, failed = by_type["高频未支付"], by_type["连续支付失败"]
    assert (unpaid.user_id, unpaid.stat_period_seconds, unpaid.unpaid_order_count, unpaid.threshold_count) == (
        2101,
        60,
        6,
        5,
    )
    assert unpaid.failed_payment_count is None and failed.unpaid_order_count is None
    assert unpaid.alert_time == datetime(2026, 8, 25, 10, 11)
    assert (failed.user_id, failed.failed_payment_count, failed.stat_period_seconds) == (2201, 3, 180)
    assert failed.alert_time == datetime(2026, 8, 25, 10, 13, 30)
    assert unpaid.risk_reason == "用户在 60 秒内产生 6 笔未支付订单，超过阈值 5 笔"


def snapshot(spark, order, detail_amount, paid, paid_ms):
    amount, create_ms = order or (None, None)
    schema = (
        "order_id long, user_id long, shop_id long, order_amount decimal(20,2), create_ms long, "
        "detail_amount decimal(20,2), detail_count int, payment_id long, payment_ms long, "
        "payment_amount decimal(20,2)"
    )
    number = lambda text: None if text is None else Decimal(text)
    row = (1, 1, 1, number(amount), create_ms, number(detail_amount), 1, 1, paid_ms, number(paid))
    return order_alerts(spark.createDataFrame([row], schema)).collect()


def test_missing_order_is_the_only_violation(spark):
    assert [r.risk_item for r in snapshot(spark, None, "99.00", "99.00", 1000)] == ["订单不存在"]


def test_sequence_and_both_amounts(spark):
    rows = snapshot(spark, ("100.00", 2000), "99.99", "99.98", 1000)
    assert [r.risk_item for r in rows] == ["支付早于下单", "明细金额不一致", "支付金额不一致"]
    assert [r.difference_amount for r in rows] == [None, Decimal("0.01"), Decimal("0.02")]


def test_consistent_order_has_no_violation(spark):
    assert snapshot(spark, ("100.00", 1000), "100.00", "100.00", 2000) == []


def test_unpaid_count_vector(spark):
    # Creations at 10000, 20000, 59999, 60000 ms, the second one paid: 2 in [0, 60000).
    from tallyguard.config import UserParams, WindowRule
    from tallyguard.operators.user_rules import window_counts
    from tallyguard.operators.windows import each_slot

    params = UserParams(unpaid=WindowRule(60_000, 10_000, 120_000, 180_000, 5, True))
    text = lambda ms: f"1970-01-01 08:{ms // 60000:02d}:{ms // 1000 % 60:02d}.{ms % 1000:03d}"
    orders = [order(i, 9, 1.0, text(ms)) for i, ms in enumerate((10000, 20000, 59999, 60000), 1)]
    events = events_of(spark, orders, payments=[payment(5, 2, 9, 1.0, text(30000))])
    counts = {r["slot"]: r["count"] for r in each_slot(window_counts(events, params)).collect()}
    assert counts[6] == 2 and counts[7] == 3


def test_failure_count_vector(spark):
    from tallyguard.config import UserParams
    from tallyguard.operators.user_rules import window_counts
    from tallyguard.operators.windows import each_slot

    text = lambda ms: f"1970-01-01 08:{ms // 60000:02d}:{ms // 1000 % 60:02d}.{ms % 1000:03d}"
    pays = [payment(i, i, 9, 1.0, text(ms), ok=False) for i, ms in enumerate((0, 1, 179999, 180000))]
    runs = window_counts(events_of(spark, payments=pays), UserParams())
    assert {r["slot"]: r["count"] for r in each_slot(runs).collect()}[18] == 3


def test_window_ends_vector(spark):
    ends = spark.range(1).select(window_ends(F.lit(12345).cast("bigint"), 60000, 10000)).first()[0]
    assert ends == [20000, 30000, 40000, 50000, 60000, 70000]


def test_user_alert_id_has_date_without_time(spark):
    end = parse_millis(F.lit("2026-08-27 23:59:58"))
    text = spark.range(1).select(user_alert_id(end, F.lit(1).cast("bigint"), F.lit("01"))).first()[0]
    assert len(text) == 21 and text.startswith("H20260827") and text[9:].isdigit()


def test_time_parse(spark):
    def parsed(*texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        ms = parse_millis(F.col("t"))
        return [tuple(r) for r in rows.select("i", ms, business_date(ms), local_time(ms)).orderBy("i").collect()]

    whole, fraction = parsed("2026-08-25 09:15:20", "2026-08-25 09:15:20.123")
    assert fraction[1] - whole[1] == 123 and whole[2] == "20260825"
    assert whole[1] == 1787620520000
    assert fraction[3] == datetime(2026, 8, 25, 9, 15, 20, 123000)
    bad = parsed(
        "2026/08/25 09:15:20",
        "2026-08-25T09:15:20",
        "2026-02-30 09:15:20",
        "2026-08-25 24:00:00",
        "2026-08-25 09:15:20.1234",
        " 2026-08-25 09:15:20",
        "2026-8-25 09:15:20",
        "2026-08-25 09:15:20\n",
    )
    assert [r[1] for r in bad] == [None] * 8
    assert parsed("2026-08-25 09:15:20.")[0][1] == whole[1]


def test_wall_clock_millis_matches_the_text_parser(spark):
    texts = ["2026-08-25 09:15:20.123", "1992-01-01 00:00:00", "2024-03-10 02:30:00", "1969-12-31 23:59:59.999"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    both = rows.select(parse_millis(F.col("t")), wall_clock_millis(F.col("t").cast("timestamp_ntz"))).collect()
    assert all(a == b for a, b in both)


def test_stable_number_matches_big_integers(spark):
    seeds = [f"{random.Random(i).getrandbits(60)}:{i}:0{i % 4}" for i in range(500)]
    rows = spark.createDataFrame([(s,) for s in seeds], "s string").select("s", stable_number(F.col("s")).alias("n"))
    for r in rows.collect():
        expected = int.from_bytes(hashlib.sha256(r.s.encode()).digest(), "big") % 10**12
        assert r.n == f"{expected:012d}"


def test_versions_copies_and_first_success(spark):
    t = DAY + "10:00:"
    orders = [
        order(1, 5, 10.0, t + "00", "a"),
        order(1, 5, 20.0, t + "01", "b"),  # the later version wins
        order(1, 5, 99.0, t + "02", "b"),  # a copy of b by id: ignored
        order(2, 5, 7.0, t + "00", "a"),  # same id under another order: kept
    ]
    details = [detail(1, 1, 5.0, t + "03", "d1"), detail(1, 1, 20.0, t + "04", "d2"), detail(3, 2, 7.0, t + "04")]
    payments = [
        payment(1, 1, 5, 20.0, t + "30"),
        payment(2, 1, 5, 77.0, t + "40"),  # second success: not judged
        payment(3, 2, 5, 7.0, t + "30", event_id="x"),
        payment(3, 2, 5, 7.0, t + "31", ok=False, event_id="y"),  # overwrites the success
    ]
    assert judge_orders(events_of(spark, orders, details, payments)).collect() == []


def brute_force(orders, payments, params):
    """User alerts by the plain definition: every window, in order, one by one."""
    picked = set()
    users = {o[1] for o in orders} | {p[1] for p in payments}
    for user in users:
        created = {i: t for i, u, t in orders if u == user}
        paid = {}
        failed = {}
        for pid, u, oid, t, ok in payments:
            if u == user and ok:
                paid[oid] = min(t, paid.get(oid, t))
            elif u == user:
                failed[pid] = t
        for code, rule in (("01", params.unpaid), ("02", params.failure)):
            times = created if code == "01" else failed
            ends = {
                (t // rule.slide_ms + 1 + i) * rule.slide_ms for t in times.values() for i in range(rule.windows)
            }
            free = None
            for end in sorted(ends):
                count = sum(
                    end - rule.size_ms <= t < end
                    and not (code == "01" and fact in paid and paid[fact] <= end + rule.wait_ms)
                    for fact, t in times.items()
                )
                if count >= rule.min_count and (free is None or end >= free):
                    picked.add((user, code, end, count))
                    free = end + rule.cooldown_ms
    return picked


@pytest.mark.parametrize("cooldown_ms, block_slots", [(180_000, 18), (175_000, 19), (50_000, 32), (10_000, 2048)])
def test_user_rules_against_brute_force(spark, cooldown_ms, block_slots):
    from tallyguard.config import UserParams, WindowRule
    from tallyguard.operators.user_rules import cooled_candidates, slot_end, window_counts

    rng = random.Random(block_slots)
    params = UserParams(
        WindowRule(60_000, 10_000, 20_000, cooldown_ms, 2, True),
        WindowRule(180_000, 10_000, 0, cooldown_ms, 3, False),
        block_slots=block_slots,
    )
    base = 1_700_000_000_000
    # User 1 is busy all the time, users 2 and 3 are sparse.
    moment = lambda u: base + rng.randrange(0, 4_000_000 if u == 1 else 9_000_000)
    users = [1] * 300 + [2] * 40 + [3] * 40
    orders = [(i, u, moment(u)) for i, u in enumerate(users)]
    payments = [(i, u, i, moment(u), False) for i, u in enumerate(users)]
    payments += [(1000 + i, u, i, t + rng.randrange(-5000, 90_000), True) for i, u, t in orders if i % 2]
    clock = lambda ms: datetime.fromtimestamp(ms / 1000, ZoneInfo("Asia/Shanghai")).strftime(
        "%Y-%m-%d %H:%M:%S.%f"
    )[:-3]
    events = events_of(
        spark,
        [order(i, u, 1.0, clock(t)) for i, u, t in orders],
        payments=[payment(i, oid, u, 1.0, clock(t), ok) for i, u, oid, t, ok in payments],
    )
    rows = cooled_candidates(window_counts(events, params), params).withColumn("end", slot_end(params)).collect()
    got = {(r["user_id"], r["code"], r["end"], r["count"]) for r in rows}
    expected = brute_force(orders, payments, params)
    assert len(expected) > 20 and len(rows) == len(got)
    assert got == expected
