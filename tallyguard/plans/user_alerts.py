"""Batch plan of the user rules: valid events in, alerts out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyguard.config import UserParams
from tallyguard.operators.user_rules import cooled_candidates, slot_end, user_alerts, window_counts


def judge_users(events: DataFrame, params: UserParams = UserParams()) -> DataFrame:
    picked = cooled_candidates(window_counts(events, params), params)
    return user_alerts(picked.withColumn("window_end_ms", slot_end(params)), params)
