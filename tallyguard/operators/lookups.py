"""The lookups an alert table serves; on a table partitioned by date the first two prune."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alerts_between(alerts: DataFrame, first_date: str, last_date: str) -> DataFrame:
    """Alerts of a range of dates by time."""
    day = F.col("alert_date")
    found = alerts.filter((day >= F.lit(first_date).cast("date")) & (day <= F.lit(last_date).cast("date")))
    return found.orderBy("alert_date", "alert_time", "alert_id")


def alerts_of_type(
    alerts: DataFrame, first_date: str, last_date: str, alert_type: str, risk_level: str | None = None
) -> DataFrame:
    found = alerts_between(alerts, first_date, last_date).filter(F.col("alert_type") == alert_type)
    return found if risk_level is None else found.filter(F.col("risk_level") == risk_level)


def alerts_of(alerts: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Alerts of the orders (or users) listed in ``keys``, by key and time."""
    return alerts.join(keys.select(key).distinct(), key, "left_semi").orderBy(key, "alert_time", "alert_id")
