import json
import tempfile

import pytest
from pyspark.sql import SparkSession

ZONES = "America/New_York"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tallyguard-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        # Any zone but the business zone: results must not depend on it.
        .config("spark.sql.session.timeZone", ZONES)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def order(order_id, user_id, amount, time, event_id=None, shop_id=301):
    return dict(
        event_id=event_id or f"o:{order_id}",
        event_type="ORDER_CREATED",
        event_time=time,
        business_date=time[:10].replace("-", ""),
        order_id=order_id,
        user_id=user_id,
        shop_id=shop_id,
        order_amount=amount,
        create_time=time,
    )


def detail(detail_id, order_id, amount, time, event_id=None):
    return dict(
        event_id=event_id or f"d:{detail_id}",
        event_type="ORDER_DETAIL",
        event_time=time,
        business_date=time[:10].replace("-", ""),
        order_detail_id=detail_id,
        order_id=order_id,
        sku_id=8001,
        sku_num=1,
        original_amount=amount,
        final_amount=amount,
        create_time=time,
    )


def payment(payment_id, order_id, user_id, amount, time, ok=True, event_id=None):
    return dict(
        event_id=event_id or f"p:{payment_id}",
        event_type="PAYMENT_SUCCESS" if ok else "PAYMENT_FAILED",
        event_time=time,
        business_date=time[:10].replace("-", ""),
        payment_id=payment_id,
        order_id=order_id,
        user_id=user_id,
        payment_status="SUCCESS" if ok else "FAILED",
        payment_amount=amount,
        payment_time=time,
    )


def lines(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


DAY = "2026-08-25 "
# The integration samples of FIXTURES.md, section 2.
SAMPLE_ORDERS = [order(1001, 2001, 100.00, DAY + "10:00:10.000")]
SAMPLE_ORDERS += [order(1101 + i, 2101, 10.00, DAY + f"10:10:{10 * i:02d}.000") for i in range(6)]
SAMPLE_ORDERS += [order(1999, 2999, 1.00, DAY + "10:20:00.000")]
SAMPLE_DETAILS = [
    detail(5001, 1001, 80.00, DAY + "10:00:11.000"),
    detail(5999, 1999, 1.00, DAY + "10:20:00.000"),
]
SAMPLE_PAYMENTS = [
    payment(7001, 1001, 2001, 90.00, DAY + "10:00:05.000"),
    payment(7002, 1002, 2002, 50.00, DAY + "10:01:00.000"),
    payment(7101, 1201, 2201, 30.00, DAY + "10:12:00.000", ok=False),
    payment(7102, 1202, 2201, 30.00, DAY + "10:12:40.000", ok=False),
    payment(7103, 1203, 2201, 30.00, DAY + "10:13:20.000", ok=False),
    payment(7999, 1999, 2999, 1.00, DAY + "10:20:00.000", ok=False),
]
GOLDEN_ORDER_IDS = {
    "H20260825776306650265": "支付早于下单",
    "M20260825064317059800": "明细金额不一致",
    "M20260825965869651928": "支付金额不一致",
    "H20260825291837090877": "订单不存在",
}
GOLDEN_USER_IDS = {"H20260825131256426984": "高频未支付", "H20260825121709709184": "连续支付失败"}
