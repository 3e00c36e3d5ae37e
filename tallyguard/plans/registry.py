"""Every operator as a query over the tables of a folder: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard import contracts as C
from tallyguard.config import DAY, HOUR, UserParams
from tallyguard.functions import ids, lines, times
from tallyguard.functions.amounts import amount_difference, money, seconds_before
from tallyguard.operators import checks, lookups, order_rules, user_rules, validate, windows
from tallyguard.operators.latest import first_copies, last_versions
from tallyguard.plans.order_alerts import judge_orders
from tallyguard.plans.streamed import run_over_tables
from tallyguard.plans.user_alerts import judge_users
from tallyguard.sources import tables
from tallyguard.sources.render import topic_columns, topic_json
from tallyguard.sources.tables import ACTIVITY_PARAMS, table
from tallyguard.streaming.order_stream import stream_order_alerts
from tallyguard.streaming.user_stream import stream_user_alerts

Query = Callable[[SparkSession, str], DataFrame]
BREAKAGE = 13


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types for a comparison across engines; of the clock time of writing only
    whether it is not before the alert."""
    columns = []
    for f in df.schema.fields:
        if f.name == "update_time":
            columns.append((F.col("update_time") >= F.col("alert_time")).alias("update_time_reached"))
            continue
        col = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, T.IntegerType):
            col = col.cast("bigint")
        elif isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            col = col.cast("string")
        columns.append(col.alias(f.name))
    return df.select(*columns)


# Sources and contract checks.
def _through_json(events_of, topic: str) -> Query:
    def query(spark, sf_dir):
        valid = validate.valid_events(topic_json(events_of(spark, sf_dir), topic), topic)
        names = [n for n in C.EVENT_SCHEMA.names if n in topic_columns(topic) or n.endswith("_time_ms")]
        other = "payment_time_ms" if topic != C.PAYMENT_TOPIC else "create_time_ms"
        return valid.select(*[n for n in names if n != other])

    return query


def damaged_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment texts of which nine in thirteen break one rule each."""
    events = tables.payment_events(spark, sf_dir)
    case = F.col("payment_id") % BREAKAGE

    def instead(number: int, value: Column, otherwise: Column) -> Column:
        return F.when(case == number, value).otherwise(otherwise)

    fields = topic_columns(C.PAYMENT_TOPIC)
    later = times.time_text(F.col("payment_time_ms") + 1000)
    fields["event_time"] = instead(3, F.translate(fields["event_time"], "-", "/"), fields["event_time"])
    fields["business_date"] = instead(4, F.lit("19000101"), fields["business_date"])
    fields["payment_time"] = instead(5, later, fields["payment_time"])
    other = F.when(F.col("payment_status") == "FAILED", F.lit("SUCCESS")).otherwise(F.lit("FAILED"))
    fields["payment_status"] = instead(6, other, F.col("payment_status"))
    fields["event_type"] = instead(7, F.lit(C.ORDER_CREATED), F.col("event_type"))
    wide = F.col("payment_amount").cast("decimal(38,2)")
    fields["payment_amount"] = F.when(case != 2, instead(8, wide + F.lit("1" + "0" * 24).cast("decimal(38,2)"), wide))

    def text(names) -> Column:
        return F.to_json(F.struct(*[fields[n].alias(n) for n in names]), {"ignoreNullFields": "false"})

    whole = text(fields)
    cut = F.expr("left(whole, length(whole) - 5)")
    texts = events.select("payment_id", whole.alias("whole"), text([n for n in fields if n != "payment_status"]).alias("lacking"))
    return texts.select(
        F.when(case == 0, cut).when(case == 1, F.col("lacking")).otherwise(F.col("whole")).alias("value")
    )


def v_money_rounding(spark, sf_dir):
    """Order texts whose amounts have twelve digits behind the point, many just off half a cent."""
    texts = topic_json(tables.order_events(spark, sf_dir), C.ORDER_TOPIC)
    order_id = F.regexp_extract("value", '"order_id":([0-9]+)', 1).cast("bigint")
    rest = F.when(order_id % 3 == 0, "4999999999").when(order_id % 3 == 1, "5000000000").otherwise("4999999995")
    amount = F.concat(F.lit('"order_amount":'), order_id, F.lit("."), F.lpad((order_id % 100).cast("string"), 2, "0"), rest)
    fine = texts.select(F.regexp_replace("value", '"order_amount":[0-9.]+', amount).alias("value"))
    valid = validate.valid_events(fine, C.ORDER_TOPIC)
    return valid.select("order_id", F.col("order_amount").cast("string").alias("order_amount"))


def v_quarantine_reasons(spark, sf_dir):
    bad = validate.quarantined(damaged_payments(spark, sf_dir), C.PAYMENT_TOPIC)
    payment_id = F.regexp_extract("value", '"payment_id":([0-9]+)', 1).cast("bigint")
    return bad.select("topic", payment_id.alias("payment_id"), F.array_join("reasons", ",").alias("reasons"))


def v_valid_payments(spark, sf_dir):
    valid = validate.valid_events(damaged_payments(spark, sf_dir), C.PAYMENT_TOPIC, strict=False)
    return valid.select("event_id", "event_type", "payment_id", "order_id", "payment_amount", "payment_time_ms")


def v_optional_rules(spark, sf_dir):
    """The opt-in sign checks, over lines whose number and amount are lowered."""
    lowered = tables.detail_events(spark, sf_dir).withColumns(
        {"sku_num": F.col("sku_num") - 25, "final_amount": money(F.col("final_amount") - 20000)}
    )
    bad = validate.quarantined(topic_json(lowered, C.DETAIL_TOPIC), C.DETAIL_TOPIC, extra=True)
    return bad.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("records"))


# Scalar functions.
def f_time_parse(spark, sf_dir):
    """Texts of several forms; the invalid ones parse to null."""
    o = table(spark, sf_dir, "orders")
    key, wall = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    form = key % 6
    text = (
        F.when(form == 0, wall)
        .when(form == 1, F.concat(wall, F.lit(".125")))
        .when(form == 2, F.translate(wall, "-", "/"))
        .when(form == 3, F.translate(wall, " ", "T"))
        .when(form == 4, F.concat(F.lit("2023-02-30"), F.substring(wall, 11, 9)))
        .otherwise(F.concat(wall, F.lit(".1234")))
    )
    return o.select("o_orderkey", times.parse_millis(text).alias("millis"))


def f_business_time(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    ms = times.wall_clock_millis(F.col("ts")) + F.col("event_id") % 1440 * 60_000
    return e.select(
        "event_id",
        times.business_date(ms).alias("business_date"),
        times.time_text(ms).alias("time_text"),
        times.local_date(ms).alias("local_date"),
    )


def f_stable_number(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    seed = F.concat_ws(":", "o_orderkey", "o_custkey", "o_orderpriority")
    return o.select("o_orderkey", ids.stable_number(seed).alias("number"))


def f_alert_ids(spark, sf_dir):
    p = tables.payment_events(spark, sf_dir)
    level = F.when(F.col("payment_id") % 2 == 0, F.lit(C.HIGH_RISK)).otherwise(F.lit(C.MEDIUM_RISK))
    time = F.col("payment_time_ms")
    return p.select(
        "payment_id",
        ids.order_alert_id(level, time, F.col("order_id"), F.col("payment_id"), F.lit("03")).alias("order_alert_id"),
        ids.user_alert_id(time, F.col("user_id"), F.lit("01")).alias("user_alert_id"),
    )


def f_differences(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    start = times.wall_clock_millis(F.col("l_shipdate"))
    price, quantity = money(F.col("l_extendedprice")), money(F.col("l_quantity"))
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        amount_difference(quantity * 100, price).alias("difference"),
        seconds_before(start, start + F.col("l_partkey") * 37).alias("seconds"),
    )


# Copies and versions.
def _resent(events: DataFrame, number: Column) -> DataFrame:
    """Each event followed by copies, each stamped a second later than the one before."""
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), number)).alias("copy")
    return events.select("*", copies).withColumn(
        "event_time_ms", F.col("event_time_ms") + F.col("copy") * 1000
    ).drop("copy")


def t_dedup(spark, sf_dir):
    sent = _resent(tables.payment_events(spark, sf_dir), F.col("payment_id") % 4)
    kept = first_copies(sent, ["order_id"])
    return kept.select("order_id", "event_id", "event_type", "event_time_ms", "payment_amount")


def t_last_write_detail(spark, sf_dir):
    facts = order_rules.order_facts(tables.detail_events(spark, sf_dir))
    last = last_versions(first_copies(facts, ["order_id"]), ["order_id", "fact", "fact_id"])
    return last.select("order_id", F.col("fact_id").alias("order_detail_id"), "event_id", "amount", "time_ms")


def t_last_write_payment(spark, sf_dir):
    """Attempts with one payment id per customer and month: the last one decides."""
    p = tables.payment_events(spark, sf_dir)
    month = F.substring("business_date", 1, 6).cast("bigint")
    merged = p.withColumn("payment_id", F.col("user_id") * 1_000_000 + month).withColumn("order_id", F.col("user_id"))
    facts = order_rules.current_order_facts(merged)
    return facts.select(F.col("fact_id").alias("payment_id"), "event_id", "success", "amount", "time_ms")


def t_union_events(spark, sf_dir):
    facts = order_rules.order_facts(tables.order_job_events(spark, sf_dir))
    return facts.groupBy("fact", "success").agg(
        F.count("*").alias("events"),
        F.min("event_time_ms").alias("first_ms"),
        F.max("event_time_ms").alias("last_ms"),
        F.sum("amount").alias("amount"),
    )


# Order rules.
def _facts(spark, sf_dir) -> DataFrame:
    return order_rules.current_order_facts(tables.order_job_events(spark, sf_dir))


def _snapshots(spark, sf_dir) -> DataFrame:
    return order_rules.paid_orders(_facts(spark, sf_dir))


def r0_detail_totals(spark, sf_dir):
    details = order_rules.current_order_facts(tables.detail_events(spark, sf_dir))
    return order_rules.detail_totals(details)


def r1_missing_order(spark, sf_dir):
    found = _snapshots(spark, sf_dir).filter(order_rules.order_missing())
    return found.select("order_id", "payment_id", "payment_ms", "detail_amount", "detail_count")


def r2_paid_before_order(spark, sf_dir):
    events = tables.order_events(spark, sf_dir).unionByName(tables.payment_events(spark, sf_dir))
    found = order_rules.paid_orders(order_rules.current_order_facts(events)).filter(order_rules.paid_before_order())
    seconds = seconds_before(F.col("payment_ms"), F.col("create_ms"))
    return found.select("order_id", "payment_id", "payment_ms", "create_ms", seconds.alias("seconds"))


def r3_detail_mismatch(spark, sf_dir):
    difference = order_rules.detail_difference()
    found = _snapshots(spark, sf_dir).filter(difference != 0)
    return found.select("order_id", "order_amount", "detail_amount", "detail_count", difference.alias("difference"))


def r3_detail_mismatch_split(spark, sf_dir):
    """The same rule on lines of which three orders in four add up."""
    parts = (tables.order_events, tables.split_details, tables.payment_events)
    events = validate.union_events(*[part(spark, sf_dir) for part in parts])
    difference = order_rules.detail_difference()
    found = order_rules.paid_orders(order_rules.current_order_facts(events)).filter(difference != 0)
    return found.select("order_id", "order_amount", "detail_amount", "detail_count", difference.alias("difference"))


def r4_paid_mismatch(spark, sf_dir):
    events = tables.order_events(spark, sf_dir).unionByName(tables.payment_events(spark, sf_dir))
    difference = order_rules.paid_difference()
    found = order_rules.paid_orders(order_rules.current_order_facts(events)).filter(difference != 0)
    return found.select("order_id", "payment_id", "order_amount", "payment_amount", difference.alias("difference"))


def r5_order_alerts(spark, sf_dir):
    return judge_orders(tables.order_job_events(spark, sf_dir))


def o11_replayed_order_alerts(spark, sf_dir):
    """Every event twice: the alerts stay the same."""
    events = tables.order_job_events(spark, sf_dir)
    twice = events.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("sent")).drop("sent")
    return judge_orders(twice)


# User rules.
def u1_window_assign(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rule = ACTIVITY_PARAMS.failure
    ends = windows.window_ends(times.wall_clock_millis(F.col("ts")), rule.size_ms, rule.slide_ms)
    return e.select("event_id", "user_id", F.explode(ends).alias("window_end_ms"))


def _counts(code: str) -> Query:
    def query(spark, sf_dir):
        runs = user_rules.window_counts(tables.activity_events(spark, sf_dir), ACTIVITY_PARAMS)
        each = windows.each_slot(runs.filter(F.col("code") == code))
        return each.select("user_id", user_rules.slot_end(ACTIVITY_PARAMS).alias("window_end_ms"), "count")

    return query


def _user_alerts(spark, sf_dir) -> DataFrame:
    return judge_users(tables.activity_events(spark, sf_dir), ACTIVITY_PARAMS)


def _alerts_of_type(alert_type: str) -> Query:
    return lambda spark, sf_dir: _user_alerts(spark, sf_dir).filter(F.col("alert_type") == alert_type)


def _default_alerts_of_type(alert_type: str) -> Query:
    """The rules at the contract's sizes, over behaviour in quick motion."""

    def query(spark, sf_dir):
        alerts = judge_users(tables.quick_activity_events(spark, sf_dir), UserParams())
        return alerts.filter(F.col("alert_type") == alert_type)

    return query


def u6_cooldown(spark, sf_dir):
    runs = user_rules.window_counts(tables.activity_events(spark, sf_dir), ACTIVITY_PARAMS)
    picked = user_rules.cooled_candidates(runs, ACTIVITY_PARAMS)
    return picked.select("user_id", "code", user_rules.slot_end(ACTIVITY_PARAMS).alias("window_end_ms"), "count")


def u8_paid_orders(spark, sf_dir):
    facts = user_rules.current_user_facts(tables.activity_events(spark, sf_dir))
    orders = facts.filter(F.col("code") == C.CODE_UNPAID)
    return orders.select("user_id", F.col("fact_id").alias("order_id"), F.col("time_ms").alias("create_ms"), "paid_ms")


# Alert rows on their way out.
def o6_order_alert_lines(spark, sf_dir):
    return r5_order_alerts(spark, sf_dir).select("alert_id", lines.order_line().alias("line"))


def o7_user_alert_lines(spark, sf_dir):
    return _user_alerts(spark, sf_dir).select("alert_id", lines.user_line().alias("line"))


_DAMAGED_TEXT_AND_TIMES = [
    ("risk_reason", lambda: F.lit(None)),
    ("risk_reason", lambda: F.rpad("risk_reason", 256, "?")),
    ("alert_date", lambda: F.date_add("alert_date", 1)),
    ("update_time", lambda: F.expr("alert_time - INTERVAL 1 SECOND")),
]


def _damaged(alerts: DataFrame, case: Column, damage: list[tuple[str, Callable[[], Column]]]) -> DataFrame:
    """Alerts of which those of case ``i`` (from 1) have the column of the i-th damage replaced."""
    columns: dict[str, Column] = {}
    for number, (name, value) in enumerate(damage, 1):
        whole = columns.get(name, F.col(name))
        columns[name] = F.when(case == number, value()).otherwise(whole)
    return alerts.withColumns(columns)


def o8_order_alert_checks(spark, sf_dir):
    """Alerts after damage by order id, with the constraints they no longer meet."""
    damaged = _damaged(
        r5_order_alerts(spark, sf_dir),
        F.col("order_id") % 13,
        [
            ("alert_type", lambda: F.lit("?")),
            ("detail_count", lambda: F.lit(-1)),
            ("difference_amount", lambda: -F.col("difference_amount")),
            ("time_difference_seconds", lambda: -F.col("time_difference_seconds")),
            ("alert_id", lambda: F.lower("alert_id")),
            ("risk_level", lambda: F.lit("?")),
            ("risk_item", lambda: F.lit("?")),
            *_DAMAGED_TEXT_AND_TIMES,
        ],
    )
    found = checks.with_broken_checks(damaged, checks.order_alert_checks())
    return found.select("alert_id", F.array_join("broken", ",").alias("broken"))


def o9_user_alert_checks(spark, sf_dir):
    """The same for user alerts; an unknown type also leaves its count without a rule."""
    damaged = _damaged(
        _user_alerts(spark, sf_dir),
        F.col("user_id") % 11,
        [
            ("alert_type", lambda: F.lit("?")),
            ("stat_period_seconds", lambda: F.lit(7)),
            ("threshold_count", lambda: F.lit(99)),
            ("threshold_count", lambda: F.lit(0)),
            ("alert_id", lambda: F.lower("alert_id")),
            ("risk_level", lambda: F.lit("?")),
            *_DAMAGED_TEXT_AND_TIMES,
        ],
    )
    found = checks.with_broken_checks(damaged, checks.user_alert_checks(ACTIVITY_PARAMS))
    return found.select("alert_id", F.array_join("broken", ",").alias("broken"))


def o10_alerts_by_date(spark, sf_dir):
    found = lookups.alerts_between(r5_order_alerts(spark, sf_dir), "1995-01-01", "1997-12-31")
    return found.select("alert_date", "alert_time", "alert_id", "risk_item")


def o10_alerts_by_type(spark, sf_dir):
    alerts = r5_order_alerts(spark, sf_dir)
    found = lookups.alerts_of_type(alerts, "1995-01-01", "1997-12-31", C.SEQUENCE_TYPE, C.HIGH_RISK)
    return found.select("alert_date", "alert_type", "risk_level", "alert_id")


def o10_alerts_by_order(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    keys = urgent.select(F.col("o_orderkey").alias("order_id"))
    found = lookups.alerts_of(r5_order_alerts(spark, sf_dir), keys, "order_id")
    return found.select("order_id", "alert_time", "alert_id")


def o10_alerts_by_user(spark, sf_dir):
    payers = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup").select("user_id")
    found = lookups.alerts_of(_user_alerts(spark, sf_dir), payers, "user_id")
    return found.select("user_id", "alert_time", "alert_id")


def o11_id_collisions(spark, sf_dir):
    return checks.id_collisions(r5_order_alerts(spark, sf_dir), ["order_id", "payment_id", "risk_item"])


# The same rules on streams.
def _stream_orders(spark, sf_dir):
    events = tables.order_job_events(spark, sf_dir)
    topics = [C.ORDER_TOPIC, C.DETAIL_TOPIC, C.PAYMENT_TOPIC]
    return run_over_tables(spark, events, topics, lambda s: stream_order_alerts(s, by_slice=True), DAY)


def _stream_immutable_orders(spark, sf_dir):
    """The variant for immutable facts, on lines that are sent once."""
    parts = (tables.order_events, tables.split_details, tables.payment_events)
    events = validate.union_events(*[part(spark, sf_dir) for part in parts])
    topics = [C.ORDER_TOPIC, C.DETAIL_TOPIC, C.PAYMENT_TOPIC]
    rules = lambda s: stream_order_alerts(s, immutable_facts=True, by_slice=True)
    return run_over_tables(spark, events, topics, rules, DAY)


def _stream_users(spark, sf_dir):
    events = tables.activity_events(spark, sf_dir)
    longest = max(ACTIVITY_PARAMS.unpaid.size_ms + ACTIVITY_PARAMS.unpaid.wait_ms, ACTIVITY_PARAMS.failure.size_ms)
    return run_over_tables(
        spark,
        events,
        [C.ORDER_TOPIC, C.PAYMENT_TOPIC],
        lambda stream: stream_user_alerts(stream, ACTIVITY_PARAMS),
        longest + HOUR,
    )


QUERIES: dict[str, Query] = {
    "s_order_json": _through_json(tables.order_events, C.ORDER_TOPIC),
    "s_detail_json": _through_json(tables.detail_events, C.DETAIL_TOPIC),
    "s_payment_json": _through_json(tables.payment_events, C.PAYMENT_TOPIC),
    "v_money_rounding": v_money_rounding,
    "v_quarantine_reasons": v_quarantine_reasons,
    "v_valid_payments": v_valid_payments,
    "v_optional_rules": v_optional_rules,
    "f_time_parse": f_time_parse,
    "f_business_time": f_business_time,
    "f_stable_number": f_stable_number,
    "f_alert_ids": f_alert_ids,
    "f_differences": f_differences,
    "t_dedup": t_dedup,
    "t_last_write_detail": t_last_write_detail,
    "t_last_write_payment": t_last_write_payment,
    "t_union_events": t_union_events,
    "r0_detail_totals": r0_detail_totals,
    "r1_missing_order": r1_missing_order,
    "r2_paid_before_order": r2_paid_before_order,
    "r3_detail_mismatch": r3_detail_mismatch,
    "r3_detail_mismatch_split": r3_detail_mismatch_split,
    "r4_paid_mismatch": r4_paid_mismatch,
    "r5_order_alerts": r5_order_alerts,
    "u1_window_assign": u1_window_assign,
    "u2_unpaid_counts": _counts(C.CODE_UNPAID),
    "u3_failure_counts": _counts(C.CODE_FAILURE),
    "u4_unpaid_alerts": _alerts_of_type(C.UNPAID_TYPE),
    "u5_failure_alerts": _alerts_of_type(C.FAILURE_TYPE),
    "u4_unpaid_alerts_default": _default_alerts_of_type(C.UNPAID_TYPE),
    "u5_failure_alerts_default": _default_alerts_of_type(C.FAILURE_TYPE),
    "u6_cooldown": u6_cooldown,
    "u8_paid_orders": u8_paid_orders,
    "u11_user_alerts": _user_alerts,
    "o6_order_alert_lines": o6_order_alert_lines,
    "o7_user_alert_lines": o7_user_alert_lines,
    "o8_order_alert_checks": o8_order_alert_checks,
    "o9_user_alert_checks": o9_user_alert_checks,
    "o10_alerts_by_date": o10_alerts_by_date,
    "o10_alerts_by_type": o10_alerts_by_type,
    "o10_alerts_by_order": o10_alerts_by_order,
    "o10_alerts_by_user": o10_alerts_by_user,
    "o11_id_collisions": o11_id_collisions,
    "o11_replayed_order_alerts": o11_replayed_order_alerts,
    "stream_order_alerts": _stream_orders,
    "stream_order_alerts_immutable": _stream_immutable_orders,
    "stream_user_alerts": _stream_users,
}


def registered() -> dict[str, Query]:
    def edge(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    return {name: edge(query) for name, query in QUERIES.items()}
