"""One-line texts of alerts for a console."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyguard import contracts as C
from tallyguard.functions.amounts import text_with


def _time(col: Column) -> Column:
    """Wall-clock text with at least one fraction digit."""
    text = col.cast("string")
    return F.when(F.instr(text, ".") > 0, text).otherwise(F.concat(text, F.lit(".0")))


def _line(metric: Column) -> Column:
    return text_with(
        C.ALERT_LINE, F.col("alert_id"), F.col("alert_type"), F.col("risk_level"), metric, _time(F.col("alert_time"))
    )


def order_line() -> Column:
    item = F.col("risk_item")
    return _line(
        F.when(item == C.PAID_BEFORE_ORDER, text_with(C.PAID_BEFORE_ORDER_METRIC, F.col("time_difference_seconds")))
        .when(item == C.DETAIL_MISMATCH, text_with(C.DETAIL_MISMATCH_METRIC, F.col("difference_amount")))
        .when(item == C.PAID_MISMATCH, text_with(C.PAID_MISMATCH_METRIC, F.col("difference_amount")))
        .otherwise(F.lit(C.ORDER_MISSING_METRIC))
    )


def user_line() -> Column:
    period, limit = F.col("stat_period_seconds"), F.col("threshold_count")
    return _line(
        F.when(
            F.col("alert_type") == C.UNPAID_TYPE,
            text_with(C.UNPAID_METRIC, period, F.col("unpaid_order_count"), limit),
        ).otherwise(text_with(C.FAILURE_METRIC, period, F.col("failed_payment_count"), limit))
    )
