"""Batch plan of the order rules: valid events in, alerts out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyguard.config import OrderParams
from tallyguard.operators.order_rules import current_order_facts, order_alerts, paid_orders


def judge_orders(events: DataFrame, params: OrderParams = OrderParams()) -> DataFrame:
    return order_alerts(paid_orders(current_order_facts(events)), params)
