"""Differences of money and time, and the reason texts that quote them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyguard.contracts import MONEY


def money(value: Column) -> Column:
    return value.cast(MONEY)


def amount_difference(left: Column, right: Column) -> Column:
    return money(F.abs(left - right))


def seconds_before(earlier_ms: Column, later_ms: Column) -> Column:
    """Whole seconds between two instants, at least one."""
    return F.greatest(F.lit(1).cast("bigint"), F.floor((later_ms - earlier_ms) / 1000).cast("bigint"))


def text_with(template: str, *values: Column) -> Column:
    """``template`` with each ``{}`` replaced by a value's text."""
    parts = template.split("{}")
    columns = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:], strict=True):
        columns += [value.cast("string"), F.lit(part)]
    return F.concat(*columns)
