"""User risk rules: sliding-window counts of unpaid orders and failed payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.config import UserParams, WindowRule
from tallyguard.contracts import (
    CODE_FAILURE,
    CODE_UNPAID,
    FAILURE_REASON,
    FAILURE_TYPE,
    HIGH_RISK,
    ORDER_CREATED,
    ORDER_DETAIL,
    PAYMENT_FAILED,
    PAYMENT_SUCCESS,
    UNPAID_REASON,
    UNPAID_TYPE,
    USER_ALERT_SCHEMA,
)
from tallyguard.functions.amounts import text_with
from tallyguard.functions.ids import user_alert_id
from tallyguard.functions.times import local_date, local_time, now_local
from tallyguard.operators.cooldown import cooled_down
from tallyguard.operators.latest import first_copies
from tallyguard.operators.validate import known_event_type
from tallyguard.operators.windows import count_runs, first_window_slot

KEYS = ["user_id", "code"]


def by_rule(params: UserParams, value) -> Column:
    """A rule's number chosen by the ``code`` column."""
    return F.when(F.col("code") == CODE_UNPAID, F.lit(value(params.unpaid)).cast("bigint")).otherwise(
        F.lit(value(params.failure)).cast("bigint")
    )


def user_facts(events: DataFrame) -> DataFrame:
    """Order creations and payment attempts under the rule and the fact they belong to.

    A creation and a success meet on the order id within the user, a failure stands
    under its payment id. Lines of orders have no user and are left out.
    """
    event_type = F.col("event_type")
    failed = event_type == PAYMENT_FAILED
    used = events.filter(event_type.isNull() | (event_type != ORDER_DETAIL))
    return used.filter(known_event_type()).select(
        "user_id",
        "event_id",
        "event_time_ms",
        F.when(failed, F.lit(CODE_FAILURE)).otherwise(F.lit(CODE_UNPAID)).alias("code"),
        F.when(failed, F.col("payment_id")).otherwise(F.col("order_id")).alias("fact_id"),
        (event_type == PAYMENT_SUCCESS).alias("paid"),
        F.when(event_type == ORDER_CREATED, F.col("create_time_ms"))
        .otherwise(F.col("payment_time_ms"))
        .alias("time_ms"),
    )


def current_user_facts(events: DataFrame) -> DataFrame:
    """Per (user, rule, fact): the last start time and the first payment, copies removed."""
    facts = first_copies(user_facts(events), ["user_id"])
    version = F.struct("event_time_ms", "event_id", "time_ms")
    paid = F.col("paid")
    merged = facts.groupBy(*KEYS, "fact_id").agg(
        F.max(F.when(~paid, version)).alias("last"), F.min(F.when(paid, F.col("time_ms"))).alias("paid_ms")
    )
    return merged.filter(F.col("last").isNotNull()).select(
        *KEYS, "fact_id", F.col("last.time_ms").alias("time_ms"), "paid_ms"
    )


def counted_windows(first_slot: Column, paid_ms: Column, windows: Column, slide: Column, wait: Column) -> Column:
    """In how many windows, from the first on, a fact counts.

    An order stops counting in windows whose judgement (end plus wait) sees its payment.
    """
    open_ms = paid_ms - wait - first_slot * slide
    unpaid = F.greatest(F.lit(0).cast("bigint"), F.ceil(open_ms / slide).cast("bigint"))
    return F.when(paid_ms.isNull(), windows).otherwise(F.least(windows, unpaid))


def window_items(facts: DataFrame, params: UserParams) -> DataFrame:
    """Facts placed on window slots: ``first_slot`` and the number of ``slots``."""
    slide = by_rule(params, lambda r: r.slide_ms)
    placed = facts.withColumn("first_slot", first_window_slot(F.col("time_ms"), slide))
    slots = counted_windows(
        F.col("first_slot"),
        F.col("paid_ms"),
        by_rule(params, lambda r: r.windows),
        slide,
        by_rule(params, lambda r: r.wait_ms),
    )
    return placed.select(*KEYS, "first_slot", slots.alias("slots"))


def window_counts(events: DataFrame, params: UserParams) -> DataFrame:
    """Runs of windows with a positive count, per user and rule."""
    return count_runs(window_items(current_user_facts(events), params), KEYS, params.block_slots)


def candidates(runs: DataFrame, params: UserParams) -> DataFrame:
    """Runs that reach their rule's threshold."""
    return runs.filter(F.col("count") >= by_rule(params, lambda r: r.min_count))


def cooled_candidates(runs: DataFrame, params: UserParams) -> DataFrame:
    """Candidate windows left by the cooldown: ``user_id``, ``code``, ``slot``, ``count``."""
    pause = by_rule(params, lambda r: r.cooldown_slots)
    return cooled_down(candidates(runs, params), KEYS, pause, params.block_slots)


def slot_end(params: UserParams) -> Column:
    return F.col("slot") * by_rule(params, lambda r: r.slide_ms)


def user_alerts(picked: DataFrame, params: UserParams) -> DataFrame:
    """Alert rows of picked windows (``user_id``, ``code``, ``window_end_ms``, ``count``)."""
    unpaid = F.col("code") == CODE_UNPAID
    end = F.col("window_end_ms")

    def reason(rule: WindowRule, template: str) -> Column:
        return text_with(template, F.lit(rule.period_seconds), F.col("count"), F.lit(rule.threshold))

    rows = picked.withColumns(
        {
            "alert_id": user_alert_id(end, F.col("user_id"), F.col("code")),
            "alert_type": F.when(unpaid, F.lit(UNPAID_TYPE)).otherwise(F.lit(FAILURE_TYPE)),
            "risk_level": F.lit(HIGH_RISK),
            "risk_reason": F.when(unpaid, reason(params.unpaid, UNPAID_REASON)).otherwise(
                reason(params.failure, FAILURE_REASON)
            ),
            "stat_period_seconds": by_rule(params, lambda r: r.period_seconds),
            "unpaid_order_count": F.when(unpaid, F.col("count")),
            "failed_payment_count": F.when(~unpaid, F.col("count")),
            "threshold_count": by_rule(params, lambda r: r.threshold),
            "alert_time": local_time(end),
            "alert_date": local_date(end),
            "update_time": F.greatest(now_local(), local_time(end)),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in USER_ALERT_SCHEMA.fields])
