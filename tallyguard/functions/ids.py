"""Deterministic alert ids: level letter, business date, twelve-digit stable number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyguard.contracts import HIGH_RISK
from tallyguard.functions.times import business_date

ID_MODULUS = 10**12


def stable_number(seed: Column) -> Column:
    """SHA-256 of the text as an unsigned number modulo 10^12, padded to twelve digits.

    The 64 hex digits are folded in 13 pieces of 20 bits: remainder * 2^20 stays
    below 2^60, so the whole fold fits a bigint.
    """
    digits = F.concat(F.lit("0"), F.sha2(seed, 256))

    def folded(text: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(12)),
            F.lit(0).cast("bigint"),
            lambda rest, i: (
                rest * (1 << 20) + F.conv(F.substring(text, i * 5 + 1, F.lit(5)), 16, 10).cast("bigint")
            )
            % F.lit(ID_MODULUS).cast("bigint"),
        )

    # Through a one-element array the digest is an item, computed once and not per piece.
    number = F.get(F.transform(F.array(digits), folded), F.lit(0))
    return F.lpad(number.cast("string"), 12, "0")


def order_alert_id(
    level: Column, alert_ms: Column, order_id: Column, payment_id: Column, code: Column
) -> Column:
    letter = F.when(level == HIGH_RISK, F.lit("H")).otherwise(F.lit("M"))
    return F.concat(letter, business_date(alert_ms), stable_number(F.concat_ws(":", order_id, payment_id, code)))


def user_alert_id(window_end_ms: Column, user_id: Column, code: Column) -> Column:
    seed = F.concat_ws(":", user_id, window_end_ms, code)
    return F.concat(F.lit("H"), business_date(window_end_ms), stable_number(seed))
