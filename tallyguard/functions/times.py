"""Business-time functions; none depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyguard.contracts import BUSINESS_ZONE

# Fixed value: seconds are required, a fraction has at most three digits.
TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{0,3})?\z"


def parse_millis(text: Column) -> Column:
    """Epoch milliseconds of a business-zone time text, null when it is not a valid time."""
    zoned = F.concat(F.rtrim(text, F.lit(".")), F.lit(f" {BUSINESS_ZONE}"))
    return F.when(text.rlike(TIME_PATTERN), F.unix_millis(F.try_to_timestamp(zoned)))


# Below, the zone is a literal of ``from_utc_timestamp`` and ``to_utc_timestamp``, which look it up once;
# a time text with its zone, or ``convert_timezone``, looks it up by name for every row.
def local_time(millis: Column) -> Column:
    """Business-zone wall-clock time (without zone) of epoch milliseconds."""
    wall = F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(millis), BUSINESS_ZONE))
    return F.timestamp_add("MILLISECOND", wall, _epoch())


def local_date(millis: Column) -> Column:
    return local_time(millis).cast("date")


def business_date(millis: Column) -> Column:
    """``yyyyMMdd`` in the business zone."""
    # A date has no zone, unlike the session time that a zone-less time would be turned into.
    return F.date_format(local_date(millis), "yyyyMMdd")


def time_text(millis: Column) -> Column:
    """The contract's text form, with milliseconds."""
    text = local_time(millis).cast("string")
    # The cast leaves out a fraction's last zeros.
    return F.concat(F.left(text, F.lit(19)), F.lit("."), F.rpad(F.substring(text, 21, 3), 3, "0"))


def wall_clock_millis(wall: Column) -> Column:
    """Epoch milliseconds of a zone-less wall-clock column read in the business zone."""
    since = (wall.cast("timestamp_ntz") - _epoch()).cast("interval second").cast("decimal(18,6)")
    micros = (since * 1_000_000).cast("bigint")
    return F.unix_millis(F.to_utc_timestamp(F.timestamp_micros(micros), BUSINESS_ZONE))


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def now_local() -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit(BUSINESS_ZONE), F.localtimestamp())
