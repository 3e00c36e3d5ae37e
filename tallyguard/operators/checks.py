"""Constraints of the alert tables, as named conditions over alert rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard import contracts as C
from tallyguard.config import UserParams

REASON_LENGTH = 255


def _null_or(col: str, condition: Column) -> Column:
    return F.col(col).isNull() | condition


def _common() -> dict[str, Column]:
    return {
        "risk_reason": F.col("risk_reason").isNotNull() & (F.char_length("risk_reason") <= REASON_LENGTH),
        "alert_date": F.col("alert_date") == F.col("alert_time").cast("date"),
        "update_time": F.col("update_time") >= F.col("alert_time"),
    }


def order_alert_checks() -> dict[str, Column]:
    items = (C.ORDER_MISSING, C.PAID_BEFORE_ORDER, C.DETAIL_MISMATCH, C.PAID_MISMATCH)
    required = ("order_id", "payment_id", "payment_time", "detail_amount", "payment_amount")
    rules = {f"null:{n}": F.col(n).isNotNull() for n in required}
    return rules | {
        "alert_id": F.col("alert_id").rlike(r"^[HM][0-9]{20}\z"),
        "alert_type": F.col("alert_type").isin(C.SEQUENCE_TYPE, C.AMOUNT_TYPE),
        "risk_level": F.col("risk_level").isin(C.HIGH_RISK, C.MEDIUM_RISK),
        "risk_item": F.col("risk_item").isin(*items),
        "detail_count": F.col("detail_count") >= 0,
        "difference_amount": _null_or("difference_amount", F.col("difference_amount") >= 0),
        "time_difference": _null_or("time_difference_seconds", F.col("time_difference_seconds") >= 0),
        **_common(),
    }


def user_alert_checks(params: UserParams = UserParams()) -> dict[str, Column]:
    unpaid, failed, limit = F.col("unpaid_order_count"), F.col("failed_payment_count"), F.col("threshold_count")
    periods = (params.unpaid.period_seconds, params.failure.period_seconds)
    return {
        "null:user_id": F.col("user_id").isNotNull(),
        "alert_id": F.col("alert_id").rlike(r"^H[0-9]{20}\z"),
        "alert_type": F.col("alert_type").isin(C.UNPAID_TYPE, C.FAILURE_TYPE),
        "risk_level": F.col("risk_level") == C.HIGH_RISK,
        "stat_period": F.col("stat_period_seconds").isin(*periods),
        "threshold": limit > 0,
        "risk_count": (
            (F.col("alert_type") == C.UNPAID_TYPE) & unpaid.isNotNull() & (unpaid > limit) & failed.isNull()
        )
        | ((F.col("alert_type") == C.FAILURE_TYPE) & unpaid.isNull() & failed.isNotNull() & (failed >= limit)),
        **_common(),
    }


def broken_checks(checks: dict[str, Column]) -> Column:
    """Names of the conditions a row does not meet."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    )


def with_broken_checks(alerts: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return alerts.select("*", F.explode(F.array(broken_checks(checks))).alias("broken"))


def id_collisions(alerts: DataFrame, natural_key: list[str]) -> DataFrame:
    """How many different alerts share an id with another one (the id space is finite)."""
    facts = alerts.select("alert_id", *natural_key).distinct()
    per_id = facts.groupBy("alert_id").agg(F.count("*").alias("facts"))
    return per_id.agg(
        F.coalesce(F.sum("facts"), F.lit(0)).alias("alerts"),
        F.count("*").alias("alert_ids"),
        F.coalesce(F.sum(F.col("facts") - 1), F.lit(0)).alias("collisions"),
    )
