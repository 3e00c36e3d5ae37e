"""Order risk rules: snapshots of paid orders and the alerts they raise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.config import OrderParams
from tallyguard.contracts import (
    AMOUNT_TYPE,
    CODE_DETAIL_MISMATCH,
    CODE_ORDER_MISSING,
    CODE_PAID_BEFORE_ORDER,
    CODE_PAID_MISMATCH,
    DETAIL_MISMATCH,
    DETAIL_MISMATCH_REASON,
    HIGH_RISK,
    MEDIUM_RISK,
    MONEY,
    ORDER_ALERT_SCHEMA,
    ORDER_CREATED,
    ORDER_DETAIL,
    ORDER_MISSING,
    ORDER_MISSING_REASON,
    PAID_BEFORE_ORDER,
    PAID_BEFORE_ORDER_REASON,
    PAID_MISMATCH,
    PAID_MISMATCH_REASON,
    PAYMENT_SUCCESS,
    SEQUENCE_TYPE,
)
from tallyguard.functions.amounts import amount_difference, money, seconds_before, text_with
from tallyguard.functions.ids import order_alert_id
from tallyguard.functions.times import local_date, local_time, now_local
from tallyguard.operators.latest import first_copies, last_versions
from tallyguard.operators.validate import known_event_type


def order_facts(events: DataFrame) -> DataFrame:
    """Events reduced to what the order rules read.

    ``fact`` and ``fact_id`` name what a later event overwrites: the order itself, one
    of its lines, or one payment attempt.
    """
    event_type = F.col("event_type")
    is_order, is_detail = event_type == ORDER_CREATED, event_type == ORDER_DETAIL
    return events.filter(known_event_type()).select(
        "order_id",
        "event_id",
        "event_time_ms",
        F.when(is_order, F.lit("order"))
        .when(is_detail, F.lit("detail"))
        .otherwise(F.lit("payment"))
        .alias("fact"),
        F.when(is_order, F.lit(0)).when(is_detail, F.col("order_detail_id")).otherwise(F.col("payment_id")).alias(
            "fact_id"
        ),
        (event_type == PAYMENT_SUCCESS).alias("success"),
        F.when(is_order, F.col("user_id")).alias("user_id"),
        F.when(is_order, F.col("shop_id")).alias("shop_id"),
        F.when(is_order, F.col("order_amount"))
        .when(is_detail, F.col("final_amount"))
        .otherwise(F.col("payment_amount"))
        .alias("amount"),
        F.when(is_order | is_detail, F.col("create_time_ms")).otherwise(F.col("payment_time_ms")).alias("time_ms"),
    )


def current_order_facts(events: DataFrame) -> DataFrame:
    """Copies removed within the order, then the last version of each fact."""
    return last_versions(first_copies(order_facts(events), ["order_id"]), ["order_id", "fact", "fact_id"])


def detail_totals(facts: DataFrame) -> DataFrame:
    """Sum and number of the current lines of each order."""
    lines = facts.filter(F.col("fact") == "detail")
    return lines.groupBy("order_id").agg(
        money(F.sum("amount")).alias("detail_amount"), F.count("*").cast("int").alias("detail_count")
    )


def paid_orders(facts: DataFrame) -> DataFrame:
    """One snapshot per order with a successful payment.

    Order, lines and payments of an order meet in one aggregation instead of joins: an
    order has at most one current order fact, its lines only enter as sum and count,
    and of several successes the first one is judged.
    """
    fact = F.col("fact")
    is_order, is_detail = fact == "order", fact == "detail"
    success = (fact == "payment") & F.col("success")
    payment = F.struct(
        F.col("time_ms").alias("payment_ms"), F.col("fact_id").alias("payment_id"), F.col("amount").alias("paid")
    )
    per_order = facts.groupBy("order_id").agg(
        F.max(F.when(is_order, F.col("user_id"))).alias("user_id"),
        F.max(F.when(is_order, F.col("shop_id"))).alias("shop_id"),
        F.max(F.when(is_order, F.col("amount"))).alias("order_amount"),
        F.max(F.when(is_order, F.col("time_ms"))).alias("create_ms"),
        money(F.coalesce(F.sum(F.when(is_detail, F.col("amount"))), F.lit(0).cast(MONEY))).alias("detail_amount"),
        F.count_if(is_detail).cast("int").alias("detail_count"),
        F.min(F.when(success, payment)).alias("payment"),
    )
    return per_order.filter(F.col("payment").isNotNull()).select(
        "order_id",
        "user_id",
        "shop_id",
        "order_amount",
        "create_ms",
        "detail_amount",
        "detail_count",
        F.col("payment.payment_id").alias("payment_id"),
        F.col("payment.payment_ms").alias("payment_ms"),
        F.col("payment.paid").alias("payment_amount"),
    )


# Conditions of the rules over a snapshot; those about an order need the order.
def order_missing() -> Column:
    return F.col("create_ms").isNull()


def paid_before_order() -> Column:
    return F.col("payment_ms") < F.col("create_ms")


def detail_difference() -> Column:
    return amount_difference(F.col("detail_amount"), F.col("order_amount"))


def paid_difference() -> Column:
    return amount_difference(F.col("payment_amount"), F.col("order_amount"))


def violations() -> Column:
    """The broken rules of a snapshot: only the missing order, or up to three others."""

    def violation(kind, item, level, code, reason, amount=None, seconds=None):
        return F.struct(
            F.lit(kind).alias("alert_type"),
            F.lit(item).alias("risk_item"),
            F.lit(level).alias("risk_level"),
            F.lit(code).alias("code"),
            reason.alias("risk_reason"),
            (F.lit(None) if amount is None else amount).cast(MONEY).alias("difference_amount"),
            (F.lit(None) if seconds is None else seconds).cast("bigint").alias("time_difference_seconds"),
        )

    missing = violation(
        SEQUENCE_TYPE,
        ORDER_MISSING,
        HIGH_RISK,
        CODE_ORDER_MISSING,
        F.lit(ORDER_MISSING_REASON),
    )
    seconds = seconds_before(F.col("payment_ms"), F.col("create_ms"))
    early = violation(
        SEQUENCE_TYPE,
        PAID_BEFORE_ORDER,
        HIGH_RISK,
        CODE_PAID_BEFORE_ORDER,
        text_with(PAID_BEFORE_ORDER_REASON, seconds),
        seconds=seconds,
    )
    detail = violation(
        AMOUNT_TYPE,
        DETAIL_MISMATCH,
        MEDIUM_RISK,
        CODE_DETAIL_MISMATCH,
        text_with(DETAIL_MISMATCH_REASON, detail_difference()),
        amount=detail_difference(),
    )
    paid = violation(
        AMOUNT_TYPE,
        PAID_MISMATCH,
        MEDIUM_RISK,
        CODE_PAID_MISMATCH,
        text_with(PAID_MISMATCH_REASON, paid_difference()),
        amount=paid_difference(),
    )
    others = F.array_compact(
        F.array(
            F.when(paid_before_order(), early),
            F.when(detail_difference() != 0, detail),
            F.when(paid_difference() != 0, paid),
        )
    )
    return F.when(order_missing(), F.array(missing)).otherwise(others)


def order_alerts(snapshots: DataFrame, params: OrderParams = OrderParams()) -> DataFrame:
    """Alert rows of the snapshots, one per broken rule."""
    broken = snapshots.select("*", F.inline(violations()))
    alert_ms = F.col("payment_ms") + F.lit(params.wait_ms)
    alert_time = local_time(alert_ms)
    rows = broken.withColumns(
        {
            "alert_id": order_alert_id(
                F.col("risk_level"), alert_ms, F.col("order_id"), F.col("payment_id"), F.col("code")
            ),
            "order_create_time": local_time(F.col("create_ms")),
            "payment_time": local_time(F.col("payment_ms")),
            "alert_time": alert_time,
            "alert_date": local_date(alert_ms),
            "update_time": F.greatest(now_local(), alert_time),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ORDER_ALERT_SCHEMA.fields])
