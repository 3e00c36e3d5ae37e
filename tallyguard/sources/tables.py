"""Events derived from relational order, order-line and activity tables.

``orders`` and ``lineitem`` give creations, lines and payment attempts; ``events``
gives the short-period behaviour of users. Wall-clock times are read in the business
zone. Every rule is plain arithmetic on one row, so nothing shuffles here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.config import DAY, HOUR, UserParams, WindowRule
from tallyguard.contracts import (
    EVENT_SCHEMA,
    MONEY,
    ORDER_CREATED,
    ORDER_DETAIL,
    PAYMENT_FAILED,
    PAYMENT_SUCCESS,
    STATUS_OF_TYPE,
)
from tallyguard.functions.amounts import money
from tallyguard.functions.times import business_date, wall_clock_millis

# Days and hours instead of seconds: the activity table is sparse.
ACTIVITY_PARAMS = UserParams(
    unpaid=WindowRule(7 * DAY, DAY, 12 * HOUR, 7 * DAY, 2, True),
    failure=WindowRule(DAY, 4 * HOUR, 0, DAY, 3, False),
    ttl_ms=30 * DAY,
)
# Distance between a user's order ids in the activity mapping; day numbers stay below it.
USER_SPAN = 100_000
# Quick motion: a day passes in 17.28 seconds, counted from a later start; a click opens up to five orders,
# and every other purchase is for an order that is eight days older.
QUICK, QUICK_START, QUICK_ORDERS, QUICK_LATER = 5_000, 1_700_000_000_000, 5, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(rows: DataFrame, event_type: Column | str, **columns: Column) -> DataFrame:
    """Unified events from column expressions; the payload time is ``event_time_ms``."""
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    time = columns["event_time_ms"]
    values = {"event_type": kind, "business_date": business_date(time), **columns}
    return rows.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creations of the orders; every eleventh one is missing."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 11 != 0)
    time = wall_clock_millis(F.col("o_orderdate"))
    return _events(
        o,
        ORDER_CREATED,
        event_id=F.concat_ws(":", F.lit("order"), F.col("o_orderkey")),
        event_time_ms=time,
        order_id=F.col("o_orderkey"),
        user_id=F.col("o_custkey"),
        shop_id=F.col("o_orderkey") % 100,
        order_amount=money(F.col("o_totalprice")),
        create_time_ms=time,
    )


def detail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; a line number that repeats within an order is a later version."""
    line = table(spark, sf_dir, "lineitem")
    time = wall_clock_millis(F.col("l_shipdate"))
    amount = money(F.col("l_extendedprice"))
    names = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return _events(
        line,
        ORDER_DETAIL,
        event_id=F.concat_ws(":", F.lit("detail"), *names, amount),
        event_time_ms=time,
        order_detail_id=F.col("l_orderkey") * 100 + F.col("l_linenumber"),
        order_id=F.col("l_orderkey"),
        sku_id=F.col("l_partkey"),
        sku_num=F.col("l_quantity"),
        original_amount=amount,
        final_amount=amount,
        create_time_ms=time,
    )


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts: finished orders were paid, pending ones failed; some early, some a cent off."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    o = table(spark, sf_dir, "orders").filter(status.isin("F", "P"))
    time = wall_clock_millis(F.col("o_orderdate")) + (key % 7 - 2) * 60_000
    kind = F.when(status == "F", F.lit(PAYMENT_SUCCESS)).otherwise(F.lit(PAYMENT_FAILED))
    state = F.when(status == "F", F.lit(STATUS_OF_TYPE[PAYMENT_SUCCESS])).otherwise(
        F.lit(STATUS_OF_TYPE[PAYMENT_FAILED])
    )
    extra = F.when(key % 5 == 0, F.lit("0.01")).otherwise(F.lit("0.00")).cast(MONEY)
    return _events(
        o,
        kind,
        event_id=F.concat_ws(":", F.lit("payment"), key),
        event_time_ms=time,
        payment_id=key,
        order_id=key,
        user_id=F.col("o_custkey"),
        payment_status=state,
        payment_amount=money(F.col("o_totalprice")) + extra,
        payment_time_ms=time,
    )


def split_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lines per order that add up to its amount, but for every fourth order."""
    key, total = F.col("o_orderkey"), money(F.col("o_totalprice"))
    half = F.floor(total / 2, F.lit(2)).cast(MONEY)
    off = F.when(key % 4 == 0, F.lit("0.07")).otherwise(F.lit("0.00")).cast(MONEY)
    parts = F.array(
        F.struct(F.lit(1).alias("part"), half.alias("amount")),
        F.struct(F.lit(2).alias("part"), (total - half + off).cast(MONEY).alias("amount")),
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.inline(parts))
    time = wall_clock_millis(F.col("o_orderdate"))
    return _events(
        o,
        ORDER_DETAIL,
        event_id=F.concat_ws(":", F.lit("half"), key, F.col("part")),
        event_time_ms=time,
        order_detail_id=key * 10 + F.col("part"),
        order_id=key,
        sku_id=key,
        sku_num=F.lit(1),
        original_amount=F.col("amount"),
        final_amount=F.col("amount"),
        create_time_ms=time,
    )


def order_job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three topics of the order rules as one stream of events."""
    return (
        order_events(spark, sf_dir)
        .unionByName(detail_events(spark, sf_dir))
        .unionByName(payment_events(spark, sf_dir))
    )


def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User behaviour: a click opens the user's order of that day, a purchase pays the
    order of the day before, an error is a failed payment."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "purchase", "error"))
    time = wall_clock_millis(F.col("ts"))
    kind, user = F.col("event_type"), F.col("user_id")
    day = F.floor(time / DAY).cast("bigint")
    order_id = (
        F.when(kind == "click", user * USER_SPAN + day)
        .when(kind == "purchase", user * USER_SPAN + day - 1)
        .otherwise(F.col("event_id"))
    )
    click = kind == "click"
    event_type = (
        F.when(click, F.lit(ORDER_CREATED))
        .when(kind == "purchase", F.lit(PAYMENT_SUCCESS))
        .otherwise(F.lit(PAYMENT_FAILED))
    )
    state = F.when(kind == "purchase", F.lit(STATUS_OF_TYPE[PAYMENT_SUCCESS])).when(
        kind == "error", F.lit(STATUS_OF_TYPE[PAYMENT_FAILED])
    )
    amount = money(F.col("value"))
    return _events(
        e,
        event_type,
        event_id=F.concat_ws(":", kind, F.col("event_id")),
        event_time_ms=time,
        order_id=order_id,
        user_id=user,
        shop_id=F.when(click, F.lit(1)),
        order_amount=F.when(click, amount),
        create_time_ms=F.when(click, time),
        payment_id=F.when(~click, F.col("event_id")),
        payment_status=state,
        payment_amount=F.when(~click, amount),
        payment_time_ms=F.when(~click, time),
    )


def quick_activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same behaviour in quick motion, dense enough for windows of a minute: a click opens one to
    five orders of its day, and a purchase pays one that the day before, or nine days before, may have."""

    def quick(name: str) -> Column:
        return F.floor(F.col(name) / QUICK).cast("bigint") + QUICK_START

    times = {name: quick(name) for name in ("event_time_ms", "create_time_ms", "payment_time_ms")}
    moved = activity_events(spark, sf_dir).withColumns(times)
    moved = moved.withColumn("business_date", business_date(F.col("event_time_ms")))
    event, kind = F.substring_index("event_id", ":", -1).cast("bigint"), F.col("event_type")
    number = event % QUICK_ORDERS
    earlier = F.when(kind == PAYMENT_SUCCESS, event % 2 * QUICK_LATER).otherwise(0)
    order = (F.col("order_id") - earlier) * QUICK_ORDERS
    opened = F.when(kind == ORDER_CREATED, F.sequence(F.lit(0).cast("bigint"), number)).otherwise(F.array(number))
    parted = moved.withColumn("part", F.explode(opened))
    names = {
        "event_id": F.when(kind == ORDER_CREATED, F.concat_ws(":", "event_id", "part")).otherwise(F.col("event_id")),
        "order_id": F.when(kind == PAYMENT_FAILED, F.col("order_id")).otherwise(order + F.col("part")),
    }
    return parted.withColumns(names).drop("part")
