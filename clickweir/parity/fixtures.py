"""Inputs of the registered queries, derived in Spark from the whole given tables.

Every row of a base table becomes one log line, message or dictionary range. The
dirty variants (blank fields, malformed texts, missing parameters) are chosen by
the row's own key, so that the expected answer can be computed from base columns.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.operators.columns import computed_once

# Agent texts by user_id % 7; 5 has no agent parameter and 6 a blank one.
AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/52.0.2743.82 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10.10; rv:42.0) Gecko/20100101 Firefox/42.0",
    "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 9_1 like Mac OS X) AppleWebKit/601.1.46 "
    "(KHTML, like Gecko) Version/9.0 Mobile/13B143 Safari/601.1",
    "curl/7.43.0",
]

# Dictionary texts by c_custkey % 15; the last is the customer's own name.
GEO_TEXTS = [
    "广东省深圳市", "江苏省", "内蒙古赤峰市", "广西南宁市", "新疆", "北京市海淀区", "重庆市忠县",
    "上海市", "香港", "澳门特别行政区", "局域网", " CZ88.NET", "", "美",
]

TOPIC = "etlTopic"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_lines(events: DataFrame) -> DataFrame:
    """(event_id, value): one access-log line per event."""
    agent = "CASE user_id % 7 " + " ".join(
        f"WHEN {i} THEN 'b_iev={quote(text, safe='()')}'" for i, text in enumerate(AGENTS)
    ) + " WHEN 6 THEN 'b_iev=%20' END"
    params = [
        "'u_nu=1'",
        "concat('u_sd=S', user_id, '-', k)",
        "concat('c_time=', ms)",
        "CASE user_id % 4 WHEN 0 THEN 'ver=1' WHEN 1 THEN 'ver=2' WHEN 3 THEN 'ver=%20' END",
        "concat('en=', CASE event_type WHEN 'signup' THEN 'e_l' WHEN 'view' THEN 'e_pv' "
        "WHEN 'purchase' THEN 'e_cs' WHEN 'click' THEN 'e_e' ELSE 'e_bad' END)",
        "CASE user_id % 5 WHEN 0 THEN 'pl=website' WHEN 1 THEN 'pl=java_server' "
        "WHEN 2 THEN 'pl=%20' WHEN 4 THEN 'pl=website' END",
        "'sdk=js'",
        "'b_rst=1440*900'",
        "CASE WHEN user_id % 29 > 0 THEN concat('u_ud=U', lpad(user_id, 8, '0')) END",
        "CASE WHEN event_id % 3 = 0 THEN concat('u_mid=M', user_id) END",
        agent,
        # Repeated, over-long, malformed and valueless parameters.
        "'l=en'", "'tt=%E5%95%86%E5%93%81=x'", "'bad=%zz'", "'flag'", "'kv_color=red'", "'l=zh-CN'",
    ]
    base = events.select(
        "event_id", "user_id", "event_type",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    line = F.expr(
        f"""concat_ws('^A',
            CASE WHEN event_id % 43 = 5 THEN '' WHEN event_id % 41 = 3 THEN '10.300.1.1'
                 ELSE concat_ws('.', CASE WHEN event_id % 2 = 0 THEN '10' ELSE '1' END,
                                user_id % 256, event_id % 256, k) END,
            CASE WHEN event_id % 50 = 7 THEN 'n/a'
                 ELSE concat(ms div 1000, '.', lpad(ms % 1000, 3, '0')) END,
            concat('www', user_id % 3, '.example.com'),
            concat('/log.gif?', concat_ws('&', {', '.join(params)}))
        )"""
    )
    return computed_once(base, "value", line).select("event_id", "value")


def dirty_log_lines(events: DataFrame) -> DataFrame:
    """Log lines of which some have three or five fields, are blank or end in a separator."""
    return log_lines(events).selectExpr(
        "event_id",
        """CASE event_id % 10
             WHEN 0 THEN regexp_replace(value, '\\\\^Awww.*$', '')
             WHEN 1 THEN concat(value, '^Aextra')
             WHEN 2 THEN '  '
             WHEN 3 THEN concat(value, '^A')
             WHEN 4 THEN replace(value, '/log.gif?', '/log.gif??')
             ELSE value END AS value""",
    )


def ip_ranges(customers: DataFrame, nations: DataFrame) -> DataFrame:
    """Address ranges: a narrow one per customer in 10/8 and up, a wide one per nation in 1/8."""
    text = "CASE c_custkey % 15 " + " ".join(
        f"WHEN {i} THEN '{t}'" for i, t in enumerate(GEO_TEXTS)
    ) + " ELSE c_name END"
    narrow = customers.selectExpr(
        "167772160 + c_custkey * 4096 AS begin_ip_num",
        "167772160 + c_custkey * 4096 + "
        "CASE c_custkey % 3 WHEN 0 THEN 4095 WHEN 1 THEN 2047 ELSE 1023 END AS end_ip_num",
        f"{text} AS country",
        "c_mktsegment AS area",
    )
    wide = nations.selectExpr(
        "16777216 + CAST(n_nationkey AS BIGINT) * 655360 AS begin_ip_num",
        "16777216 + CAST(n_nationkey AS BIGINT) * 655360 + 524287 AS end_ip_num",
        "n_name AS country",
        "CASE WHEN n_nationkey % 2 = 0 THEN ' CZ88.NET' ELSE 'backbone' END AS area",
    )
    return narrow.unionByName(wide)


def nested_ranges(customers: DataFrame, nations: DataFrame) -> DataFrame:
    """``ip_ranges`` with a wide range around all of 10/8, nested and repeated ones."""
    ranges = ip_ranges(customers, nations)
    inner = customers.where("c_custkey % 2 = 0").selectExpr(
        "167772160 + c_custkey * 4096 + 16 AS begin_ip_num",
        "167772160 + c_custkey * 4096 + 271 AS end_ip_num",
        "concat('inner ', c_name) AS country", "c_mktsegment AS area")
    again = inner.where("begin_ip_num % 3 = 0").selectExpr(
        "begin_ip_num", "end_ip_num", "concat('later ', country) AS country", "area")
    outer = nations.where("n_nationkey = 0").selectExpr(
        "CAST(167772160 AS BIGINT) AS begin_ip_num", "CAST(184549375 AS BIGINT) AS end_ip_num",
        "'outer' AS country", "n_name AS area")
    return ranges.unionByName(inner).unionByName(again).unionByName(outer)


def geo_texts(customers: DataFrame) -> DataFrame:
    text = "CASE c_custkey % 15 " + " ".join(
        f"WHEN {i} THEN '{t}'" for i, t in enumerate(GEO_TEXTS)
    ) + " ELSE c_name END"
    return customers.selectExpr("c_custkey", f"{text} AS geo_text")


_PROVINCE = "CAST(o_custkey % 34 + 1 AS INT)"


def sale_order_messages(orders: DataFrame) -> DataFrame:
    """JSON orders; some are not JSON, lack the province or carry an extra property."""
    message = F.expr(
        f"""CASE o_orderkey % 19
              WHEN 3 THEN 'not json'
              WHEN 4 THEN to_json(named_struct('orderId', CAST(o_orderkey AS STRING),
                                               'orderPrice', o_totalprice))
              WHEN 5 THEN to_json(named_struct('orderId', CAST(o_orderkey AS STRING),
                                               'provinceId', {_PROVINCE},
                                               'orderPrice', o_totalprice, 'note', 'x'))
              ELSE to_json(named_struct('orderId', CAST(o_orderkey AS STRING),
                                        'provinceId', {_PROVINCE}, 'orderPrice', o_totalprice))
            END"""
    )
    return computed_once(orders, "value", message).select("value")


def csv_messages(orders: DataFrame) -> DataFrame:
    """CSV orders; some are too short, too long, blank or not numeric."""
    message = F.expr(
        f"""CASE o_orderkey % 23
              WHEN 0 THEN concat_ws(',', o_orderkey, {_PROVINCE})
              WHEN 1 THEN concat_ws(',', o_orderkey, {_PROVINCE}, o_totalprice, 'x')
              WHEN 2 THEN '   '
              WHEN 3 THEN concat(o_orderkey, ',', {_PROVINCE}, ',')
              WHEN 4 THEN concat_ws(',', o_orderkey, concat('p', {_PROVINCE}), o_totalprice)
              WHEN 5 THEN concat(o_orderkey, ', ', {_PROVINCE}, ',', o_totalprice)
              ELSE concat_ws(',', o_orderkey, {_PROVINCE}, o_totalprice)
            END"""
    )
    return computed_once(orders, "value", message).select("value")


def typed_order_messages(orders: DataFrame) -> DataFrame:
    """Message columns with typed JSON orders; a customer's orders share one order id."""
    return orders.selectExpr(
        f"'{TOPIC}' AS topic",
        "CAST(o_orderkey % 3 AS INT) AS partition",
        "o_orderkey AS offset",
        "CAST(o_orderdate AS TIMESTAMP) AS timestamp",
        "CAST(o_orderkey AS STRING) AS key",
        f"""to_json(named_struct(
              'orderType', CASE o_orderpriority WHEN '1-URGENT' THEN 'alipay'
                WHEN '2-HIGH' THEN 'weixin' WHEN '3-MEDIUM' THEN 'card'
                WHEN '4-NOT SPECIFIED' THEN 'voucher' END,
              'orderId', concat('C', o_custkey),
              'provinceId', {_PROVINCE},
              'orderPrice', o_totalprice)) AS value""",
    )


def dated_prices(orders: DataFrame) -> DataFrame:
    """Orders with province, price and time; a third of them are province 1's."""
    return orders.selectExpr(
        f"CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE CAST({_PROVINCE} AS INT) END AS province_id",
        "o_totalprice AS order_price", "CAST(o_orderdate AS TIMESTAMP) AS ts")


def dirty_typed_messages(orders: DataFrame) -> DataFrame:
    """Typed order messages of which some are no JSON and some lack the order id."""
    return typed_order_messages(orders).withColumn("value", F.expr("""
        CASE WHEN offset % 11 = 0 THEN concat('broken ', value)
             WHEN offset % 13 = 0 THEN replace(value, 'orderId', 'order') ELSE value END"""))


def purchases(events: DataFrame) -> DataFrame:
    """Purchase events as orders with a province and a time."""
    return events.where("event_type = 'purchase'").selectExpr(
        "CAST(user_id % 34 + 1 AS INT) AS province_id", "CAST(ts AS TIMESTAMP) AS ts"
    )


def visits(events: DataFrame) -> DataFrame:
    """Events as visits, some without a user; a third of the rest is one user's."""
    return events.selectExpr(
        "CASE WHEN user_id % 29 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'U0' "
        "ELSE concat('U', user_id) END AS user",
        "CAST(ts AS TIMESTAMP) AS ts", "event_type = 'view' AS page_view", "event_id")


def referrals(events: DataFrame) -> DataFrame:
    """(key, at, tie, value): referrers of some page views, at full hours, so with ties."""
    return events.where("event_type = 'view' AND event_id % 3 > 0").select(
        _hot_user(), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at"),
        F.col("event_id").alias("tie"), F.expr("concat('ref', event_id % 7)").alias("value"))


def buyers(events: DataFrame) -> DataFrame:
    """(key, at, event_id): purchases at full hours."""
    return events.where("event_type = 'purchase'").select(
        _hot_user(), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at"), "event_id")


def _hot_user():
    return F.expr("CASE WHEN user_id % 29 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 0 "
                  "ELSE user_id END").alias("key")


def created_orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr("o_orderkey AS order_id", "CAST(o_orderdate AS TIMESTAMP) AS created_at",
                             "CAST(o_totalprice AS DECIMAL(18, 2)) AS amount")


def order_outcomes(orders: DataFrame) -> DataFrame:
    """Payments, some of them late or before the order, and refunds, some without a payment."""
    at = "CAST(o_orderdate AS TIMESTAMP) + make_interval(0, 0, 0, 0, {hours})"
    paid = orders.where("o_orderkey % 4 > 0").selectExpr(
        "o_orderkey AS order_id", "'paid' AS outcome",
        at.format(hours="CAST(CASE o_orderkey % 9 WHEN 5 THEN 60 WHEN 7 THEN -2 "
                        "ELSE o_orderkey % 40 END AS INT)") + " AS outcome_at")
    refunded = orders.where("o_orderkey % 6 = 1 OR o_orderkey % 8 = 0").selectExpr(
        "o_orderkey AS order_id", "'refunded' AS outcome", at.format(hours="30") + " AS outcome_at")
    return paid.unionByName(refunded)
