"""Quarantine reasons, strict mode, settings, alert checks and merge text."""

import json

import pytest
from conftest import DAY, detail, lines, order, payment
from pyspark.sql import functions as F

from tallyguard import contracts as C
from tallyguard.config import JobConfig, UserParams, WindowRule
from tallyguard.operators.validate import quarantined, valid_events
from tallyguard.plans.order_alerts import judge_orders
from tallyguard.plans.user_alerts import judge_users
from tallyguard.functions.times import business_date, time_text
from tallyguard.sinks.alert_log import append_batch, current_alerts, read_log
from tallyguard.sinks.jdbc import merge_statement, staging_options, staging_table
from tallyguard.sinks.shared import job_folder
from tallyguard.sources.kafka import kafka_options

T = DAY + "10:00:00"


def without(record, name):
    return {k: v for k, v in record.items() if k != name}


CASES = [
    (C.ORDER_TOPIC, "not json", ["malformed_json"]),
    (C.ORDER_TOPIC, "[1, 2]", None),
    (C.ORDER_TOPIC, json.dumps(order(1, 1, 1.0, T))[:-5], ["malformed_json"]),
    (C.ORDER_TOPIC, without(order(1, 1, 1.0, T), "shop_id"), ["missing:shop_id"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "user_id": None}, ["null:user_id"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "event_type": "ORDER_DETAIL"}, ["event_type"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "event_time": "2026-02-30 10:00:00"}, ["event_time"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "business_date": "20260826"}, ["business_date"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "create_time": T + ".001"}, ["payload_time"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "create_time": "soon"}, ["payload_time"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "order_amount": 10**25}, ["range:order_amount"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "order_amount": 10**18}, ["range:order_amount"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "order_amount": "ten"}, ["malformed_json"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "order_id": 1.5}, ["type:order_id"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "shop_id": 10**19}, ["type:shop_id"]),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "order_id": "12", "order_amount": "3.10"}, []),
    (C.ORDER_TOPIC, {**order(1, 1, 1.0, T), "create_time": T + ".000"}, []),
    (C.DETAIL_TOPIC, {**detail(1, 1, 1.0, T), "sku_num": None}, ["null:sku_num"]),
    (C.DETAIL_TOPIC, {**detail(1, 1, 1.0, T), "sku_num": -1}, []),
    (C.PAYMENT_TOPIC, {**payment(1, 1, 1, 1.0, T), "payment_status": "FAILED"}, ["payment_status"]),
    (C.PAYMENT_TOPIC, {**payment(1, 1, 1, 1.0, T), "event_type": "PAYMENT_FAILED"}, ["payment_status"]),
    (C.PAYMENT_TOPIC, {**payment(1, 1, 1, 1.0, T), "event_type": "REFUND"}, ["event_type"]),
    (
        C.PAYMENT_TOPIC,
        {**payment(1, 1, 1, 1.0, T), "business_date": "x", "payment_amount": None, "payment_status": "?"},
        ["null:payment_amount", "business_date", "payment_status"],
    ),
]


def test_every_rule_quarantines_with_its_reason(spark):
    for topic in C.TOPIC_SCHEMAS:
        mine = [c for c in CASES if c[0] == topic]
        texts = [c[1] if isinstance(c[1], str) else json.dumps(c[1]) for c in mine]
        raw = spark.createDataFrame([(t,) for t in texts], "value string")
        found = {r.value: r.reasons for r in quarantined(raw, topic).collect()}
        for (_, _, reasons), text in zip(mine, texts):
            if reasons is None:
                assert found[text]
            else:
                assert found.get(text, []) == reasons, text
        valid = valid_events(raw, topic, strict=False).count()
        assert valid == sum(c[2] == [] for c in mine)


def test_strict_mode_stops_on_form_only(spark):
    dropped = [{"event_time": "soon"}, {"order_amount": 10**20}, {"user_id": None}]
    bad = lines(spark, [{**order(1, 1, 1.0, T), **d} for d in dropped] + [order(2, 1, 1.0, T)])
    assert [r.order_id for r in valid_events(bad, C.ORDER_TOPIC).collect()] == [2]
    for record in (without(order(1, 1, 1.0, T), "shop_id"), {**order(1, 1, 1.0, T), "order_id": "x"}):
        with pytest.raises(Exception, match="ods_order_info: "):
            valid_events(lines(spark, [record]), C.ORDER_TOPIC).collect()


def test_optional_rules(spark):
    raw = lines(spark, [{**detail(1, 1, -1.0, T), "sku_num": 0}])
    assert quarantined(raw, C.DETAIL_TOPIC).count() == 0
    row = quarantined(raw, C.DETAIL_TOPIC, extra=True).first()
    assert sorted(row.reasons) == ["negative:final_amount", "negative:original_amount", "sku_num"]


def test_money_keeps_two_digits(spark):
    text = json.dumps(order(1, 1, 1.0, T)).replace('"order_amount": 1.0', '"order_amount": 123456789012345678.91')
    raw = spark.createDataFrame([(text,)], "value string")
    assert str(valid_events(raw, C.ORDER_TOPIC).first().order_amount) == "123456789012345678.91"


def test_unknown_event_type_stops_the_rules(spark):
    events = valid_events(lines(spark, [payment(1, 1, 1, 1.0, T)]), C.PAYMENT_TOPIC)
    for judge in (judge_orders, judge_users):
        with pytest.raises(Exception, match="unsupported event type: REFUND"):
            judge(events.withColumn("event_type", F.lit("REFUND"))).collect()


def test_output_schemas(spark):
    events = valid_events(lines(spark, [payment(1, 1, 1, 1.0, T)]), C.PAYMENT_TOPIC)
    for judge, schema in ((judge_orders, C.ORDER_ALERT_SCHEMA), (judge_users, C.USER_ALERT_SCHEMA)):
        assert [(f.name, f.dataType) for f in judge(events).schema] == [(f.name, f.dataType) for f in schema]
    assert len(C.ORDER_ALERT_SCHEMA) == 20 and len(C.USER_ALERT_SCHEMA) == 12


def test_alert_times_are_not_after_the_update(spark):
    row = judge_orders(valid_events(lines(spark, [payment(1, 1, 1, 1.0, T)]), C.PAYMENT_TOPIC)).first()
    assert row.update_time >= row.alert_time


def test_settings_from_the_environment():
    env = {
        "KAFKA_BOOTSTRAP_SERVERS": "a:1,b:2",
        "MYSQL_HOST": "db",
        "MYSQL_PORT": "3307",
        "MYSQL_USER": "u",
        "MYSQL_PASSWORD": "p",
        "CHECKPOINT_ROOT": "/shared/cp/",
    }
    config = JobConfig.from_env(C.ORDER_JOB, env)
    assert config.checkpoint_dir == "/shared/cp/order-risk/"
    assert config.mysql_url.startswith("jdbc:mysql://db:3307/realtime?")
    assert kafka_options(config, C.ORDER_TOPIC)["startingOffsets"] == "earliest"
    assert staging_options(config, "s")["batchsize"] == "100"
    empty = JobConfig.from_env(C.USER_JOB, {})
    assert empty.mysql_url is None and empty.checkpoint_dir is None
    with pytest.raises(ValueError):
        kafka_options(empty, C.ORDER_TOPIC)


def test_window_rules_are_checked():
    with pytest.raises(ValueError):
        WindowRule(60_000, 7_000, 0, 0, 1, True)
    with pytest.raises(ValueError):
        UserParams(block_slots=17)


def test_merge_statement():
    text = merge_statement("t", "s", ["alert_id", "a", "b"])
    assert text == (
        "INSERT INTO t (alert_id, a, b) SELECT alert_id, a, b FROM s "
        "ON DUPLICATE KEY UPDATE a = VALUES(a), b = VALUES(b)"
    )


def test_time_text_in_a_gap_of_the_session_zone(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    # 2026-03-08 02:30:00.120 in the business zone: New York has no such time that day.
    row = spark.range(1).select(time_text(F.lit(1772908200120)).alias("t"), business_date(F.lit(1772908200120)).alias("d"))
    assert tuple(row.first()) == ("2026-03-08 02:30:00.120", "20260308")


def test_no_alert_of_another_job_or_run_is_lost(spark, tmp_path):
    path = str(tmp_path)
    rows = judge_orders(valid_events(lines(spark, [payment(1, 1, 1, 1.0, T)]), C.PAYMENT_TOPIC))
    append_batch(rows, path, 0, C.ORDER_JOB, "a")
    append_batch(rows.limit(0), path, 0, C.USER_JOB, "b")
    append_batch(rows.withColumn("alert_id", F.lit("other")), path, 0, C.ORDER_JOB, "c")
    append_batch(rows, path, 0, C.ORDER_JOB, "a")
    assert read_log(spark, path, C.ORDER_ALERT_SCHEMA, C.ORDER_JOB).count() == 2
    assert current_alerts(spark, path, C.ORDER_ALERT_SCHEMA, C.ORDER_JOB).count() == 2


def test_job_folder_is_the_same_at_every_start(spark):
    assert job_folder(spark, C.ORDER_JOB) == job_folder(spark, C.ORDER_JOB) != job_folder(spark, C.USER_JOB)


def test_intake_bounds_from_the_environment():
    config = JobConfig.from_env(C.ORDER_JOB, {"KAFKA_BOOTSTRAP_SERVERS": "a:1", "MAX_OFFSETS_PER_TRIGGER": "500"})
    assert kafka_options(config, C.ORDER_TOPIC, config.max_offsets)["maxOffsetsPerTrigger"] == "500"


def test_staging_tables_are_not_shared():
    assert len({staging_table("t", r, b) for r in ("a-1", "b-2") for b in (1, 2)}) == 4
