"""Input schemas, label texts and output columns of the risk contract."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(20, 2)
BUSINESS_ZONE = "Asia/Shanghai"

# Event types and payment states of the input contract.
ORDER_CREATED = "ORDER_CREATED"
ORDER_DETAIL = "ORDER_DETAIL"
PAYMENT_SUCCESS = "PAYMENT_SUCCESS"
PAYMENT_FAILED = "PAYMENT_FAILED"
EVENT_TYPES = (ORDER_CREATED, ORDER_DETAIL, PAYMENT_SUCCESS, PAYMENT_FAILED)
STATUS_OF_TYPE = {PAYMENT_SUCCESS: "SUCCESS", PAYMENT_FAILED: "FAILED"}

# Topic names, alert tables and consumer groups.
ORDER_TOPIC = "ods_order_info"
DETAIL_TOPIC = "ods_order_detail"
PAYMENT_TOPIC = "ods_payment_info"
ORDER_ALERT_TABLE = "rt_order_risk_alert"
USER_ALERT_TABLE = "rt_user_risk_alert"
ORDER_JOB = "order-risk"
USER_JOB = "user-risk"

# Label texts, part of the output contract.
SEQUENCE_TYPE = "订单时序异常"
AMOUNT_TYPE = "订单金额异常"
ORDER_MISSING = "订单不存在"
PAID_BEFORE_ORDER = "支付早于下单"
DETAIL_MISMATCH = "明细金额不一致"
PAID_MISMATCH = "支付金额不一致"
UNPAID_TYPE = "高频未支付"
FAILURE_TYPE = "连续支付失败"
HIGH_RISK = "高风险"
MEDIUM_RISK = "中风险"

# Reason texts; {} stands for a value.
ORDER_MISSING_REASON = "成功支付已到达，但未收到对应订单创建事件"
PAID_BEFORE_ORDER_REASON = "支付时间早于订单创建时间 {} 秒"
DETAIL_MISMATCH_REASON = "订单明细金额合计与订单金额不一致，差额为 {} 元"
PAID_MISMATCH_REASON = "支付金额与订单金额不一致，差额为 {} 元"
UNPAID_REASON = "用户在 {} 秒内产生 {} 笔未支付订单，超过阈值 {} 笔"
FAILURE_REASON = "用户在 {} 秒内连续支付失败 {} 次，达到阈值 {} 次"

# The console line and its metric per kind of alert; {} stands for a value.
ALERT_LINE = "告警ID={}，告警类型={}，风险等级={}，核心异常指标={}，告警时间={}"
ORDER_MISSING_METRIC = "订单创建事件缺失"
PAID_BEFORE_ORDER_METRIC = "支付早于下单{}秒"
DETAIL_MISMATCH_METRIC = "明细金额差额{}元"
PAID_MISMATCH_METRIC = "支付金额差额{}元"
UNPAID_METRIC = "{}秒内未支付订单{}笔，阈值{}笔"
FAILURE_METRIC = "{}秒内支付失败{}次，阈值{}次"

# Rule codes that enter the alert ids.
CODE_ORDER_MISSING = "01"
CODE_PAID_BEFORE_ORDER = "02"
CODE_DETAIL_MISMATCH = "03"
CODE_PAID_MISMATCH = "04"
CODE_UNPAID = "01"
CODE_FAILURE = "02"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()
_HEADER = (("event_id", _S), ("event_type", _S), ("event_time", _S), ("business_date", _S))

ORDER_SCHEMA = _struct(
    *_HEADER, ("order_id", _L), ("user_id", _L), ("shop_id", _L), ("order_amount", MONEY), ("create_time", _S)
)
DETAIL_SCHEMA = _struct(
    *_HEADER,
    ("order_detail_id", _L),
    ("order_id", _L),
    ("sku_id", _L),
    ("sku_num", _I),
    ("original_amount", MONEY),
    ("final_amount", MONEY),
    ("create_time", _S),
)
PAYMENT_SCHEMA = _struct(
    *_HEADER,
    ("payment_id", _L),
    ("order_id", _L),
    ("user_id", _L),
    ("payment_status", _S),
    ("payment_amount", MONEY),
    ("payment_time", _S),
)
TOPIC_SCHEMAS = {ORDER_TOPIC: ORDER_SCHEMA, DETAIL_TOPIC: DETAIL_SCHEMA, PAYMENT_TOPIC: PAYMENT_SCHEMA}
# The column of a topic that must repeat ``event_time``.
PAYLOAD_TIME = {ORDER_TOPIC: "create_time", DETAIL_TOPIC: "create_time", PAYMENT_TOPIC: "payment_time"}
TOPIC_EVENT_TYPES = {
    ORDER_TOPIC: (ORDER_CREATED,),
    DETAIL_TOPIC: (ORDER_DETAIL,),
    PAYMENT_TOPIC: (PAYMENT_SUCCESS, PAYMENT_FAILED),
}

# One wide row for every kind of event; columns of other kinds are null.
EVENT_SCHEMA = _struct(
    ("event_id", _S),
    ("event_type", _S),
    ("event_time_ms", _L),
    ("business_date", _S),
    ("order_id", _L),
    ("user_id", _L),
    ("shop_id", _L),
    ("order_amount", MONEY),
    ("create_time_ms", _L),
    ("order_detail_id", _L),
    ("sku_id", _L),
    ("sku_num", _I),
    ("original_amount", MONEY),
    ("final_amount", MONEY),
    ("payment_id", _L),
    ("payment_status", _S),
    ("payment_amount", MONEY),
    ("payment_time_ms", _L),
)

ORDER_ALERT_SCHEMA = _struct(
    ("alert_id", _S),
    ("alert_type", _S),
    ("risk_item", _S),
    ("risk_level", _S),
    ("risk_reason", _S),
    ("order_id", _L),
    ("user_id", _L),
    ("shop_id", _L),
    ("payment_id", _L),
    ("order_create_time", T.TimestampNTZType()),
    ("payment_time", T.TimestampNTZType()),
    ("order_amount", MONEY),
    ("detail_amount", MONEY),
    ("payment_amount", MONEY),
    ("difference_amount", MONEY),
    ("time_difference_seconds", _L),
    ("detail_count", _I),
    ("alert_time", T.TimestampNTZType()),
    ("alert_date", T.DateType()),
    ("update_time", T.TimestampNTZType()),
)
USER_ALERT_SCHEMA = _struct(
    ("alert_id", _S),
    ("alert_type", _S),
    ("risk_level", _S),
    ("risk_reason", _S),
    ("user_id", _L),
    ("stat_period_seconds", _I),
    ("unpaid_order_count", _I),
    ("failed_payment_count", _I),
    ("threshold_count", _I),
    ("alert_time", T.TimestampNTZType()),
    ("alert_date", T.DateType()),
    ("update_time", T.TimestampNTZType()),
)
