"""Column names, event aliases and message schemas.

The literals below are fixed values: they are the wire names of the log
parameters, event aliases and JSON properties that producers send.
"""

from __future__ import annotations

from pyspark.sql import types as T

LOG_SEPARATOR = "^A"

# Event alias -> (id, description).
EVENTS = {
    "e_l": (1, "launch event"),
    "e_pv": (2, "page view event"),
    "e_crt": (3, "charge request event"),
    "e_cs": (4, "charge success event"),
    "e_cr": (5, "charge refund event"),
    "e_e": (6, "event duration event"),
}
LAUNCH = "e_l"

PLATFORM_WEBSITE = "website"
PLATFORM_JAVA_SERVER = "java_server"

UNKNOWN = "unknown"
# Label of a total over all values of a dimension.
ALL = "all"
EVENT_TABLE = "event_logs"

HEADER_COLUMNS = ["ip", "s_time", "http_host"]
PARAM_COLUMNS = [
    "en", "ver", "u_ud", "u_mid", "u_sd", "c_time", "l", "b_iev", "b_rst", "pl",
    "p_url", "p_ref", "tt", "oid", "on", "cua", "cut", "pt", "ca", "ac", "du",
]
AGENT_COLUMNS = ["os", "os_v", "browser", "browser_v"]
REGION_COLUMNS = ["country", "province", "city"]
EVENT_COLUMNS = HEADER_COLUMNS + PARAM_COLUMNS + AGENT_COLUMNS + REGION_COLUMNS

# The columns the new-user analysis reads from a day of events.
LAUNCH_COLUMNS = ["u_ud", "s_time", "pl", "ver", "browser", "browser_v"]

ORDER_TYPES = ["alipay", "weixin", "card"]
OTHER_SINK = "other"

SALE_ORDER = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("provinceId", T.IntegerType()),
    T.StructField("orderPrice", T.FloatType()),
])

IP_RANGES = T.StructType([
    T.StructField("begin_ip_num", T.LongType()),
    T.StructField("end_ip_num", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("area", T.StringType()),
])

DAY_PLATFORM_BROWSER = T.StructType([
    T.StructField("uuid", T.StringType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("platformDimension", T.StringType()),
    T.StructField("browserDimension", T.StringType()),
])

OFFSET_LEDGER = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("until_offset", T.LongType()),
])

# Columns every order stream exposes, whatever the transport.
MESSAGE_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value"]
