"""The registered queries in plain SQL for DuckDB, written from the rules themselves."""

from __future__ import annotations

SHANGHAI_MS = 8 * 3_600_000
DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def ms(col: str) -> str:
    """Epoch milliseconds of a wall-clock column (the zone has had no shift since 1992)."""
    return f"(epoch_us({col}) // 1000 - {SHANGHAI_MS})"


def local(millis: str) -> str:
    return f"make_timestamp((({millis}) + {SHANGHAI_MS}) * 1000)"


def day_text(millis: str) -> str:
    return f"strftime({local(millis)}, '%Y%m%d')"


def time_text(millis: str) -> str:
    return f"strftime({local(millis)}, '%Y-%m-%d %H:%M:%S.%g')"


def stable(seed: str) -> str:
    piece = f"CAST('0x' || substr('0' || sha256({seed}), i * 5 + 1, 5) AS BIGINT)"
    fold = "lambda a, c: (a * 1048576 + c) % 1000000000000"
    return f"lpad(CAST(list_reduce([{piece} for i in range(13)], {fold}) AS VARCHAR), 12, '0')"


def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(20,2))"


def double(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


PAY_MS = f"({ms('o_orderdate')} + ((o_orderkey % 7) - 2) * 60000)"

# One CTE per topic, with the columns the rules read.
ORDERS = f"""
o AS (SELECT 'order:' || o_orderkey AS event_id, o_orderkey AS order_id, o_custkey AS user_id,
             o_orderkey % 100 AS shop_id, {money('o_totalprice')} AS order_amount,
             {ms('o_orderdate')} AS create_ms
      FROM orders WHERE o_orderkey % 11 <> 0)"""
PAYMENTS = f"""
pay AS (SELECT 'payment:' || o_orderkey AS event_id, o_orderkey AS order_id, o_orderkey AS payment_id,
               o_custkey AS user_id, o_orderstatus = 'F' AS success,
               CASE WHEN o_orderstatus = 'F' THEN 'PAYMENT_SUCCESS' ELSE 'PAYMENT_FAILED' END AS event_type,
               CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS payment_status,
               {PAY_MS} AS payment_ms,
               {money("o_totalprice")} + CASE WHEN o_orderkey % 5 = 0 THEN 0.01 ELSE 0.00 END AS payment_amount
        FROM orders WHERE o_orderstatus IN ('F', 'P'))"""
# Lines: first copy of an event, then the last version of a line number.
DETAILS = f"""
d0 AS (SELECT concat_ws(':', 'detail', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                        {money('l_extendedprice')}) AS event_id,
              l_orderkey AS order_id, l_orderkey * 100 + l_linenumber AS order_detail_id,
              {money('l_extendedprice')} AS amount, {ms('l_shipdate')} AS time_ms
       FROM lineitem),
d1 AS (SELECT order_id, event_id, order_detail_id, amount, min(time_ms) AS time_ms
       FROM d0 GROUP BY ALL),
d AS (SELECT * FROM d1 QUALIFY row_number() OVER (
        PARTITION BY order_id, order_detail_id ORDER BY time_ms DESC, event_id DESC) = 1)"""
TOTALS = f"""
tot AS (SELECT order_id, {money('sum(amount)')} AS detail_amount, count(*) AS detail_count
        FROM d GROUP BY order_id)"""
SNAPSHOTS = f"""
snap AS (SELECT p.order_id, p.payment_id, p.payment_ms, {money('p.payment_amount')} AS payment_amount,
                o.user_id, o.shop_id, o.order_amount, o.create_ms,
                coalesce(tot.detail_amount, {money('0')}) AS detail_amount,
                coalesce(tot.detail_count, 0) AS detail_count
         FROM pay p LEFT JOIN o USING (order_id) LEFT JOIN tot USING (order_id)
         WHERE p.success)"""
ORDER_CTES = ",".join([ORDERS, PAYMENTS, DETAILS, TOTALS, SNAPSHOTS])
ALERTS = f"""
v AS (
  SELECT *, '订单时序异常' AS alert_type, '订单不存在' AS risk_item, '高风险' AS risk_level, '01' AS code,
         '成功支付已到达，但未收到对应订单创建事件' AS risk_reason,
         NULL::DECIMAL(20,2) AS difference_amount, NULL::BIGINT AS time_difference_seconds
  FROM snap WHERE create_ms IS NULL
  UNION ALL
  SELECT *, '订单时序异常', '支付早于下单', '高风险', '02',
         '支付时间早于订单创建时间 ' || greatest(1, (create_ms - payment_ms) // 1000) || ' 秒',
         NULL, greatest(1, (create_ms - payment_ms) // 1000)
  FROM snap WHERE payment_ms < create_ms
  UNION ALL
  SELECT *, '订单金额异常', '明细金额不一致', '中风险', '03',
         '订单明细金额合计与订单金额不一致，差额为 ' || {money('abs(detail_amount - order_amount)')} || ' 元',
         {money('abs(detail_amount - order_amount)')}, NULL
  FROM snap WHERE detail_amount <> order_amount
  UNION ALL
  SELECT *, '订单金额异常', '支付金额不一致', '中风险', '04',
         '支付金额与订单金额不一致，差额为 ' || {money('abs(payment_amount - order_amount)')} || ' 元',
         {money('abs(payment_amount - order_amount)')}, NULL
  FROM snap WHERE payment_amount <> order_amount),
alerts AS (
  SELECT CASE WHEN risk_level = '高风险' THEN 'H' ELSE 'M' END || {day_text('payment_ms + 120000')}
           || {stable("order_id || ':' || payment_id || ':' || code")} AS alert_id,
         alert_type, risk_item, risk_level, risk_reason, order_id, user_id, shop_id, payment_id,
         {local('create_ms')} AS order_create_time, {local('payment_ms')} AS payment_time,
         order_amount, detail_amount, payment_amount, difference_amount,
         CAST(time_difference_seconds AS BIGINT) AS time_difference_seconds,
         CAST(detail_count AS BIGINT) AS detail_count,
         {local('payment_ms + 120000')} AS alert_time, CAST({local('payment_ms + 120000')} AS DATE) AS alert_date
  FROM v)"""
ORDER_COLUMNS = f"""
SELECT alert_id, alert_type, risk_item, risk_level, risk_reason, order_id, user_id, shop_id, payment_id,
       CAST(order_create_time AS VARCHAR) AS order_create_time, CAST(payment_time AS VARCHAR) AS payment_time,
       {double('order_amount')} AS order_amount, {double('detail_amount')} AS detail_amount,
       {double('payment_amount')} AS payment_amount, {double('difference_amount')} AS difference_amount,
       time_difference_seconds, detail_count, CAST(alert_time AS VARCHAR) AS alert_time,
       CAST(alert_date AS VARCHAR) AS alert_date, true AS update_time_reached
FROM alerts"""
ORDER_ALERTS = f"WITH {ORDER_CTES},{ALERTS}{ORDER_COLUMNS}"
# Two lines per order instead of the table's, seven cents too much in every fourth order.
SPLIT_TOTALS = f"""
tot AS (SELECT o_orderkey AS order_id, CAST(2 AS BIGINT) AS detail_count,
               {money("o_totalprice")} + CASE WHEN o_orderkey % 4 = 0 THEN 0.07 ELSE 0.00 END AS detail_amount
        FROM orders)"""
SPLIT_ALERTS = f"WITH {','.join([ORDERS, PAYMENTS, SPLIT_TOTALS, SNAPSHOTS])},{ALERTS}{ORDER_COLUMNS}"

# User rules, each as (size, slide, wait, threshold, pause); unpaid orders must exceed their threshold.
SPARSE_RULES = (7 * DAY_MS, DAY_MS, 12 * HOUR_MS, 2, 7 * DAY_MS), (DAY_MS, 4 * HOUR_MS, 0, 3, DAY_MS)
DEFAULT_RULES = (60_000, 10_000, 120_000, 5, 180_000), (180_000, 10_000, 0, 3, 180_000)
FAIL_SLIDE = SPARSE_RULES[1][1]
# A day in 17.28 seconds, up to five orders a click, every other purchase for an order nine days old.
QUICK = f"({ms('ts')} // 5000 + 1700000000000)"
QUICK_ORDERS, QUICK_LATER = 5, 8


def user_facts(time: str = ms("ts"), most: int = 1, later: int = 0) -> str:
    """A click opens 1 to ``most`` orders of its day; a purchase pays one of the day before, or every other of ``later`` days earlier."""
    return f"""
act AS (SELECT event_id, user_id, event_type, {time} AS time_ms, {ms('ts')} // {DAY_MS} AS day FROM events),
opened AS (SELECT *, unnest(range(1 + event_id % {most})) AS part FROM act WHERE event_type = 'click'),
ord AS (SELECT user_id, (user_id * 100000 + day) * {most} + part AS order_id, time_ms AS create_ms
        FROM opened
        QUALIFY row_number() OVER (PARTITION BY user_id, order_id
                                   ORDER BY time_ms DESC, 'click:' || event_id DESC) = 1),
paid AS (SELECT user_id, (user_id * 100000 + day - 1 - event_id % 2 * {later}) * {most} + event_id % {most} AS order_id, min(time_ms) AS paid_ms
         FROM act WHERE event_type = 'purchase' GROUP BY ALL),
ordp AS (SELECT ord.*, paid.paid_ms FROM ord LEFT JOIN paid USING (user_id, order_id))"""


def user_counts(rules: tuple = SPARSE_RULES) -> str:
    (u_size, u_slide, u_wait, _, _), (f_size, f_slide, _, _, _) = rules
    return f"""
uw AS (SELECT user_id, paid_ms, (create_ms // {u_slide} + 1 + unnest(range({u_size // u_slide}))) * {u_slide}
         AS window_end_ms FROM ordp),
uc AS (SELECT user_id, window_end_ms, count(*) AS "count" FROM uw
       WHERE paid_ms IS NULL OR paid_ms > window_end_ms + {u_wait} GROUP BY ALL),
fw AS (SELECT user_id, (time_ms // {f_slide} + 1 + unnest(range({f_size // f_slide}))) * {f_slide} AS window_end_ms
       FROM act WHERE event_type = 'error'),
fc AS (SELECT user_id, window_end_ms, count(*) AS "count" FROM fw GROUP BY ALL)"""


def picks(rules: tuple = SPARSE_RULES) -> str:
    (_, _, _, above, u_pause), (_, _, _, least, f_pause) = rules
    return f"""
cand AS (SELECT user_id, '01' AS code, window_end_ms, "count", {u_pause} AS pause FROM uc WHERE "count" > {above}
         UNION ALL SELECT user_id, '02', window_end_ms, "count", {f_pause} FROM fc WHERE "count" >= {least}),
nxt AS (SELECT a.user_id, a.code, a.window_end_ms, min(b.window_end_ms) AS next_ms
        FROM cand a JOIN cand b ON a.user_id = b.user_id AND a.code = b.code
                               AND b.window_end_ms >= a.window_end_ms + a.pause GROUP BY ALL),
chain AS (SELECT user_id, code, min(window_end_ms) AS window_end_ms FROM cand GROUP BY ALL
          UNION ALL
          SELECT chain.user_id, chain.code, nxt.next_ms FROM chain JOIN nxt
            ON chain.user_id = nxt.user_id AND chain.code = nxt.code AND chain.window_end_ms = nxt.window_end_ms),
picks AS (SELECT cand.* FROM cand JOIN chain USING (user_id, code, window_end_ms))"""


def user_rows(rules: tuple = SPARSE_RULES) -> str:
    (u_size, _, _, above, _), (f_size, _, _, least, _) = rules
    return f"""
ua AS (SELECT 'H' || {day_text('window_end_ms')} || {stable("user_id || ':' || window_end_ms || ':' || code")} AS alert_id,
       CASE code WHEN '01' THEN '高频未支付' ELSE '连续支付失败' END AS alert_type, '高风险' AS risk_level,
       CASE code WHEN '01' THEN '用户在 {u_size // 1000} 秒内产生 ' || "count" || ' 笔未支付订单，超过阈值 {above} 笔'
                 ELSE '用户在 {f_size // 1000} 秒内连续支付失败 ' || "count" || ' 次，达到阈值 {least} 次' END AS risk_reason,
       user_id, CASE code WHEN '01' THEN {u_size // 1000} ELSE {f_size // 1000} END::BIGINT AS stat_period_seconds,
       CASE code WHEN '01' THEN "count" END AS unpaid_order_count,
       CASE code WHEN '02' THEN "count" END AS failed_payment_count,
       CASE code WHEN '01' THEN {above} ELSE {least} END::BIGINT AS threshold_count,
       {local('window_end_ms')} AS alert_time, CAST({local('window_end_ms')} AS DATE) AS alert_date
FROM picks)"""


def user_ctes(time: str, rules: tuple, most: int = 1, later: int = 0) -> str:
    return ",".join([user_facts(time, most, later), user_counts(rules), picks(rules)])


USER_FACTS, USER_COUNTS = user_facts(), user_counts()
USER_CTES = user_ctes(ms("ts"), SPARSE_RULES)
USER_WITH = f"WITH RECURSIVE {USER_CTES},{user_rows()}"
DEFAULT_WITH = f"WITH RECURSIVE {user_ctes(QUICK, DEFAULT_RULES, QUICK_ORDERS, QUICK_LATER)},{user_rows(DEFAULT_RULES)}"


def user_alerts(condition: str = "true", ctes: str = USER_WITH) -> str:
    return f"""{ctes}
SELECT alert_id, alert_type, risk_level, risk_reason, user_id, stat_period_seconds, unpaid_order_count,
       failed_payment_count, threshold_count, CAST(alert_time AS VARCHAR) AS alert_time,
       CAST(alert_date AS VARCHAR) AS alert_date, true AS update_time_reached
FROM ua WHERE {condition}"""


# The console text of a whole-second time carries one fraction digit.
def line(metric: str) -> str:
    return (
        "'告警ID=' || alert_id || '，告警类型=' || alert_type || '，风险等级=' || risk_level"
        f" || '，核心异常指标=' || ({metric}) || '，告警时间=' || CAST(alert_time AS VARCHAR) || '.0'"
    )


ORDER_METRIC = """CASE risk_item WHEN '支付早于下单' THEN '支付早于下单' || time_difference_seconds || '秒'
  WHEN '明细金额不一致' THEN '明细金额差额' || difference_amount || '元'
  WHEN '支付金额不一致' THEN '支付金额差额' || difference_amount || '元'
  ELSE '订单创建事件缺失' END"""
USER_METRIC = """CASE alert_type
  WHEN '高频未支付' THEN stat_period_seconds || '秒内未支付订单' || unpaid_order_count || '笔，阈值' || threshold_count || '笔'
  ELSE stat_period_seconds || '秒内支付失败' || failed_payment_count || '次，阈值' || threshold_count || '次' END"""

ORACLES: dict[str, str] = {
    "s_order_json": f"""WITH {ORDERS}
SELECT event_id, 'ORDER_CREATED' AS event_type, create_ms AS event_time_ms, {day_text('create_ms')} AS business_date,
       order_id, user_id, shop_id, {double('order_amount')} AS order_amount, create_ms AS create_time_ms FROM o""",
    "v_money_rounding": """SELECT o_orderkey AS order_id, CAST(CAST(round(CAST(o_orderkey || '.' ||
       lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || CASE o_orderkey % 3 WHEN 0 THEN '4999999999' WHEN 1 THEN '5000000000'
       ELSE '4999999995' END AS DECIMAL(38, 12)), 2) AS DECIMAL(20, 2)) AS VARCHAR) AS order_amount
FROM orders WHERE o_orderkey % 11 <> 0""",
    "s_detail_json": f"""WITH {DETAILS}
SELECT event_id, 'ORDER_DETAIL' AS event_type, time_ms AS event_time_ms, {day_text('time_ms')} AS business_date,
       order_id, time_ms AS create_time_ms, order_detail_id, l_partkey AS sku_id, sku_num,
       {double('amount')} AS original_amount, {double('amount')} AS final_amount
FROM (SELECT concat_ws(':', 'detail', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                       {money('l_extendedprice')}) AS event_id, l_orderkey AS order_id, l_partkey,
             l_orderkey * 100 + l_linenumber AS order_detail_id, CAST(l_quantity AS BIGINT) AS sku_num,
             {money('l_extendedprice')} AS amount, {ms('l_shipdate')} AS time_ms FROM lineitem)""",
    "s_payment_json": f"""WITH {PAYMENTS}
SELECT event_id, event_type, payment_ms AS event_time_ms, {day_text('payment_ms')} AS business_date, order_id, user_id,
       payment_id, payment_status, {double('payment_amount')} AS payment_amount, payment_ms AS payment_time_ms FROM pay""",
    "v_quarantine_reasons": f"""WITH {PAYMENTS}
SELECT 'ods_payment_info' AS topic, payment_id,
       CASE payment_id % 13 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'missing:payment_status'
         WHEN 2 THEN 'null:payment_amount' WHEN 3 THEN 'event_time' WHEN 4 THEN 'business_date'
         WHEN 5 THEN 'payload_time' WHEN 6 THEN 'payment_status' WHEN 7 THEN 'event_type'
         ELSE 'range:payment_amount' END AS reasons
FROM pay WHERE payment_id % 13 <= 8""",
    "v_valid_payments": f"""WITH {PAYMENTS}
SELECT event_id, event_type, payment_id, order_id, {double('payment_amount')} AS payment_amount,
       payment_ms AS payment_time_ms FROM pay WHERE payment_id % 13 > 8""",
    "v_optional_rules": f"""
SELECT concat_ws(',', CASE WHEN l_quantity - 25 <= 0 THEN 'sku_num' END,
                 CASE WHEN {money('l_extendedprice')} - 20000 < 0 THEN 'negative:final_amount' END) AS reasons,
       count(*) AS records
FROM lineitem WHERE l_quantity - 25 <= 0 OR {money('l_extendedprice')} - 20000 < 0 GROUP BY ALL""",
    "f_time_parse": f"""
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN {ms('o_orderdate')} WHEN 1 THEN {ms('o_orderdate')} + 125 END AS millis
FROM orders""",
    "f_business_time": f"""
SELECT event_id, {day_text('t')} AS business_date, {time_text('t')} AS time_text,
       CAST(CAST({local('t')} AS DATE) AS VARCHAR) AS local_date
FROM (SELECT event_id, {ms('ts')} + event_id % 1440 * 60000 AS t FROM events)""",
    "f_stable_number": f"""
SELECT o_orderkey, {stable("o_orderkey || ':' || o_custkey || ':' || o_orderpriority")} AS number FROM orders""",
    "f_alert_ids": f"""WITH {PAYMENTS}
SELECT payment_id,
       CASE WHEN payment_id % 2 = 0 THEN 'H' ELSE 'M' END || {day_text('payment_ms')}
         || {stable("order_id || ':' || payment_id || ':03'")} AS order_alert_id,
       'H' || {day_text('payment_ms')} || {stable("user_id || ':' || payment_ms || ':01'")} AS user_alert_id FROM pay""",
    "f_differences": f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
       {double(money('abs(' + money('l_quantity') + ' * 100 - ' + money('l_extendedprice') + ')'))} AS difference,
       greatest(1, (l_partkey * 37) // 1000) AS seconds FROM lineitem""",
    "t_dedup": f"""WITH {PAYMENTS}
SELECT order_id, event_id, event_type, payment_ms AS event_time_ms, {double('payment_amount')} AS payment_amount FROM pay""",
    "t_last_write_detail": f"""WITH {DETAILS}
SELECT order_id, order_detail_id, event_id, {double('amount')} AS amount, time_ms FROM d""",
    "t_last_write_payment": f"""WITH {PAYMENTS}
SELECT user_id * 1000000 + CAST(substr({day_text('payment_ms')}, 1, 6) AS BIGINT) AS payment_id, event_id, success,
       {double('payment_amount')} AS amount, payment_ms AS time_ms
FROM pay QUALIFY row_number() OVER (PARTITION BY user_id, substr({day_text('payment_ms')}, 1, 6)
                                    ORDER BY payment_ms DESC, event_id DESC) = 1""",
    "t_union_events": f"""WITH {ORDERS},{PAYMENTS},{DETAILS},
u AS (SELECT 'order' AS fact, false AS success, create_ms AS t, order_amount AS a FROM o
      UNION ALL SELECT 'payment', success, payment_ms, payment_amount FROM pay
      UNION ALL SELECT 'detail', false, time_ms, amount FROM d0)
SELECT fact, success, count(*) AS events, min(t) AS first_ms, max(t) AS last_ms, {double('sum(a)')} AS amount
FROM u GROUP BY ALL""",
    "r0_detail_totals": f"""WITH {DETAILS},{TOTALS}
SELECT order_id, {double('detail_amount')} AS detail_amount, detail_count FROM tot""",
    "r1_missing_order": f"""WITH {ORDER_CTES}
SELECT order_id, payment_id, payment_ms, {double('detail_amount')} AS detail_amount, detail_count
FROM snap WHERE create_ms IS NULL""",
    "r2_paid_before_order": f"""WITH {ORDERS},{PAYMENTS}
SELECT order_id, payment_id, payment_ms, create_ms, greatest(1, (create_ms - payment_ms) // 1000) AS seconds
FROM pay JOIN o USING (order_id) WHERE success AND payment_ms < create_ms""",
    "r3_detail_mismatch": f"""WITH {ORDER_CTES}
SELECT order_id, {double('order_amount')} AS order_amount, {double('detail_amount')} AS detail_amount, detail_count,
       {double(money('abs(detail_amount - order_amount)'))} AS difference FROM snap WHERE detail_amount <> order_amount""",
    "r3_detail_mismatch_split": f"""WITH {ORDERS},{PAYMENTS}
SELECT order_id, {double('order_amount')} AS order_amount, {double(money('order_amount + 0.07'))} AS detail_amount,
       CAST(2 AS BIGINT) AS detail_count, CAST(0.07 AS DOUBLE) AS difference
FROM pay JOIN o USING (order_id) WHERE success AND order_id % 4 = 0""",
    "r4_paid_mismatch": f"""WITH {ORDERS},{PAYMENTS}
SELECT order_id, payment_id, {double('order_amount')} AS order_amount, {double('payment_amount')} AS payment_amount,
       {double(money('abs(payment_amount - order_amount)'))} AS difference
FROM pay JOIN o USING (order_id) WHERE success AND payment_amount <> order_amount""",
    "r5_order_alerts": ORDER_ALERTS,
    "u1_window_assign": f"""
SELECT event_id, user_id, ({ms('ts')} // {FAIL_SLIDE} + 1 + unnest(range(6))) * {FAIL_SLIDE} AS window_end_ms
FROM events""",
    "u2_unpaid_counts": f"WITH {USER_FACTS},{USER_COUNTS} SELECT * FROM uc",
    "u3_failure_counts": f"WITH {USER_FACTS},{USER_COUNTS} SELECT * FROM fc",
    "u4_unpaid_alerts": user_alerts("alert_type = '高频未支付'"),
    "u5_failure_alerts": user_alerts("alert_type = '连续支付失败'"),
    "u4_unpaid_alerts_default": user_alerts("alert_type = '高频未支付'", DEFAULT_WITH),
    "u5_failure_alerts_default": user_alerts("alert_type = '连续支付失败'", DEFAULT_WITH),
    "u6_cooldown": f'WITH RECURSIVE {USER_CTES} SELECT user_id, code, window_end_ms, "count" FROM picks',
    "u8_paid_orders": f"WITH {USER_FACTS} SELECT user_id, order_id, create_ms, paid_ms FROM ordp",
    "u11_user_alerts": user_alerts(),
    "o6_order_alert_lines": f"WITH {ORDER_CTES},{ALERTS} SELECT alert_id, {line(ORDER_METRIC)} AS line FROM alerts",
    "o7_user_alert_lines": f"{USER_WITH} SELECT alert_id, {line(USER_METRIC)} AS line FROM ua",
    "o8_order_alert_checks": f"""WITH {ORDER_CTES},{ALERTS}
SELECT CASE order_id % 13 WHEN 5 THEN lower(alert_id) ELSE alert_id END AS alert_id,
       CASE order_id % 13 WHEN 1 THEN 'alert_type' WHEN 2 THEN 'detail_count'
         WHEN 3 THEN CASE WHEN difference_amount IS NULL THEN '' ELSE 'difference_amount' END
         WHEN 4 THEN CASE WHEN time_difference_seconds IS NULL THEN '' ELSE 'time_difference' END
         WHEN 5 THEN 'alert_id' WHEN 6 THEN 'risk_level' WHEN 7 THEN 'risk_item' WHEN 8 THEN 'risk_reason'
         WHEN 9 THEN 'risk_reason' WHEN 10 THEN 'alert_date' WHEN 11 THEN 'update_time' ELSE '' END AS broken
FROM alerts""",
    "o9_user_alert_checks": f"""{USER_WITH}
SELECT CASE user_id % 11 WHEN 5 THEN lower(alert_id) ELSE alert_id END AS alert_id,
       CASE user_id % 11 WHEN 1 THEN 'alert_type,risk_count' WHEN 2 THEN 'stat_period' WHEN 3 THEN 'risk_count'
         WHEN 4 THEN 'threshold' WHEN 5 THEN 'alert_id' WHEN 6 THEN 'risk_level' WHEN 7 THEN 'risk_reason'
         WHEN 8 THEN 'risk_reason' WHEN 9 THEN 'alert_date' WHEN 10 THEN 'update_time' ELSE '' END AS broken
FROM ua""",
    "o10_alerts_by_date": f"""WITH {ORDER_CTES},{ALERTS}
SELECT CAST(alert_date AS VARCHAR) AS alert_date, CAST(alert_time AS VARCHAR) AS alert_time, alert_id, risk_item
FROM alerts WHERE alert_date BETWEEN DATE '1995-01-01' AND DATE '1997-12-31' ORDER BY ALL""",
    "o10_alerts_by_type": f"""WITH {ORDER_CTES},{ALERTS}
SELECT CAST(alert_date AS VARCHAR) AS alert_date, alert_type, risk_level, alert_id FROM alerts
WHERE alert_date BETWEEN DATE '1995-01-01' AND DATE '1997-12-31' AND alert_type = '订单时序异常' AND risk_level = '高风险'""",
    "o10_alerts_by_order": f"""WITH {ORDER_CTES},{ALERTS}
SELECT order_id, CAST(alert_time AS VARCHAR) AS alert_time, alert_id FROM alerts
WHERE order_id IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "o10_alerts_by_user": f"""{USER_WITH}
SELECT user_id, CAST(alert_time AS VARCHAR) AS alert_time, alert_id FROM ua
WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')""",
    "o11_id_collisions": f"""WITH {ORDER_CTES},{ALERTS}
SELECT count(*) AS alerts, count(DISTINCT alert_id) AS alert_ids, count(*) - count(DISTINCT alert_id) AS collisions
FROM alerts""",
    "o11_replayed_order_alerts": ORDER_ALERTS,
    "stream_order_alerts": ORDER_ALERTS,
    "stream_order_alerts_immutable": SPLIT_ALERTS,
    "stream_user_alerts": user_alerts(),
}
