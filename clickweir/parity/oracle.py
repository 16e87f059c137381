"""DuckDB SQL answering each registered query straight from the base tables."""

from __future__ import annotations

from clickweir.parity.fixtures import AGENTS, GEO_TEXTS, TOPIC
from clickweir.schemas import EVENTS

# --- shared relations ----------------------------------------------------------

_AGENT_FACTS = [  # browser, version, system, system name by user_id % 7
    ("Chrome", "52.0.2743.82", "Windows", "Windows 10"),
    ("Firefox", "42.0", "OS X", "OS X 10.10"),
    ("IE", "9.0", "Windows", "Windows 7"),
    ("Safari", "9.0", "iOS", "iOS 9"),
    ("unknown", None, "unknown", "unknown"),
]


def _case(subject: str, values: list, otherwise: str = "NULL") -> str:
    def literal(v) -> str:
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"

    arms = " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(values))
    return f"CASE {subject} {arms} ELSE {otherwise} END"


_LOGS = f"""
base AS (
  SELECT event_id, user_id, ts, event_type, epoch_us(ts) // 1000 AS ms,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events),
logs AS (
  SELECT event_id, user_id, k, ms,
    CASE WHEN event_id % 43 = 5 THEN '' WHEN event_id % 41 = 3 THEN '10.300.1.1'
         ELSE (CASE WHEN event_id % 2 = 0 THEN '10.' ELSE '1.' END) || (user_id % 256) || '.'
              || (event_id % 256) || '.' || k END AS ip,
    CASE WHEN event_id % 43 = 5 OR event_id % 41 = 3 THEN NULL
         ELSE (((CASE WHEN event_id % 2 = 0 THEN 10 ELSE 1 END) * 256 + user_id % 256) * 256
               + event_id % 256) * 256 + k END AS ip_num,
    CASE WHEN event_id % 50 = 7 THEN 'n/a'
         ELSE (ms // 1000) || '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') END AS s_time,
    CASE WHEN event_id % 50 = 7 THEN -1
         ELSE CAST(trunc(CAST((ms // 1000) || '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0')
                              AS DOUBLE) * 1000) AS BIGINT) END AS s_millis,
    'www' || (user_id % 3) || '.example.com' AS http_host,
    CASE event_type WHEN 'signup' THEN 'e_l' WHEN 'view' THEN 'e_pv' WHEN 'purchase' THEN 'e_cs'
                    WHEN 'click' THEN 'e_e' ELSE 'e_bad' END AS en,
    CASE user_id % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 3 THEN ' ' END AS ver,
    CASE WHEN user_id % 29 > 0 THEN 'U' || lpad(CAST(user_id AS VARCHAR), 8, '0') END AS u_ud,
    CASE WHEN event_id % 3 = 0 THEN 'M' || user_id END AS u_mid,
    'S' || user_id || '-' || k AS u_sd,
    CAST(ms AS VARCHAR) AS c_time,
    'zh-CN' AS l,
    CASE user_id % 7 WHEN 6 THEN ' ' ELSE {_case('user_id % 7', AGENTS)} END AS b_iev,
    '1440*900' AS b_rst,
    CASE user_id % 5 WHEN 0 THEN 'website' WHEN 1 THEN 'java_server' WHEN 2 THEN ' '
                     WHEN 4 THEN 'website' END AS pl,
    '商品' AS tt,
    {_case('user_id % 7', [f[0] for f in _AGENT_FACTS])} AS browser,
    {_case('user_id % 7', [f[1] for f in _AGENT_FACTS])} AS browser_v,
    {_case('user_id % 7', [f[2] for f in _AGENT_FACTS])} AS os,
    {_case('user_id % 7', [f[3] for f in _AGENT_FACTS])} AS os_v
  FROM base),
known AS (SELECT * FROM logs WHERE en <> 'e_bad')"""

_RANGES = f"""
ranges AS (
  SELECT 167772160 + c_custkey * 4096 AS begin_ip_num,
         167772160 + c_custkey * 4096
           + CASE c_custkey % 3 WHEN 0 THEN 4095 WHEN 1 THEN 2047 ELSE 1023 END AS end_ip_num,
         {_case('c_custkey % 15', GEO_TEXTS, 'c_name')} AS country, c_mktsegment AS area,
         c_custkey % 15 AS kind
  FROM customer
  UNION ALL
  SELECT 16777216 + CAST(n_nationkey AS BIGINT) * 655360,
         16777216 + CAST(n_nationkey AS BIGINT) * 655360 + 524287, n_name,
         CASE WHEN n_nationkey % 2 = 0 THEN ' CZ88.NET' ELSE 'backbone' END, 99
  FROM nation)"""

# Expected country, province and city of each dictionary text, by position.
_REGIONS = [
    ("中国", "广东省", "深圳市"),
    ("中国", "江苏省", "unknown"),
    ("中国", "内蒙古自治区", "赤峰市"),
    ("中国", "广西", "南宁市"),
    ("中国", "新疆", "unknown"),
    ("中国", "北京市", "海淀区"),
    ("中国", "重庆市", "忠县"),
    ("中国", "上海市", "unknown"),
    ("中国", "香港特别行政区", "unknown"),
    ("中国", "澳门特别行政区", "unknown"),
    ("中国", "上海市", "unknown"),
    ("中国", "上海市", "unknown"),
    ("中国", "上海市", "unknown"),
    ("unknown", "unknown", "unknown"),
]


def _region(kind: str, whole: str) -> str:
    columns = zip(*_REGIONS, strict=True)
    return ", ".join(
        f"{_case(kind, list(values), otherwise)} AS {name}"
        for name, values, otherwise in zip(
            ("country", "province", "city"), columns, (whole, "'unknown'", "'unknown'"),
            strict=True,
        )
    )


_CRC = """
crc_table AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce(range(8), lambda c, i:
      CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n) AS v
    FROM range(256) r(n))),
keyed AS (
  SELECT known.*, s_millis || '_' || xor(4294967295, list_reduce(
      list_transform(string_split(coalesce(u_ud, '') || coalesce(u_mid, '') || en, ''),
                     lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS row_key
  FROM known, crc_table)"""

_LAUNCHES = """
launches AS (
  SELECT u_ud AS uuid,
    CAST(day(make_timestamp(s_millis * 1000)) AS INTEGER) AS day,
    CASE WHEN trim(coalesce(pl, '')) = '' THEN 'unknown:unknown'
         WHEN trim(coalesce(ver, '')) = '' THEN pl || ':unknown'
         ELSE pl || ':' || ver END AS platformDimension,
    CASE WHEN browser IS NULL THEN 'unknown:unknown'
         WHEN browser_v IS NULL THEN browser || ':unknown'
         ELSE browser || ':' || split_part(browser_v, '.', 1) END AS browserDimension
  FROM known WHERE en = 'e_l' AND u_ud IS NOT NULL)"""

_BY_PLATFORM = f"""WITH {_LOGS}, {_LAUNCHES}
SELECT day, platformDimension, CAST(count(*) AS BIGINT) AS total FROM launches GROUP BY ALL"""

_BY_BROWSER = f"""WITH {_LOGS}, {_LAUNCHES}
SELECT day, platformDimension, browserDimension, CAST(count(*) AS BIGINT) AS total
FROM launches GROUP BY ALL"""

_IP_REGION = f"""WITH {_LOGS}, {_RANGES}
SELECT event_id, ip, coalesce(r.country, '未知国家') AS geo_country,
       coalesce(r.area, '未知地区') AS geo_area
FROM logs LEFT JOIN ranges r ON ip_num BETWEEN begin_ip_num AND end_ip_num"""

_IP_REGION_NESTED = f"""WITH {_LOGS}, {_RANGES},
nested AS (
  SELECT begin_ip_num, end_ip_num, country, area FROM ranges
  UNION ALL
  SELECT 167772160 + c_custkey * 4096 + 16, 167772160 + c_custkey * 4096 + 271,
         'inner ' || c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 0
  UNION ALL
  SELECT 167772160 + c_custkey * 4096 + 16, 167772160 + c_custkey * 4096 + 271,
         'later inner ' || c_name, c_mktsegment FROM customer
  WHERE c_custkey % 2 = 0 AND (167772160 + c_custkey * 4096 + 16) % 3 = 0
  UNION ALL
  SELECT 167772160, 184549375, 'outer', n_name FROM nation WHERE n_nationkey = 0
), addresses AS (
  SELECT ip_num, country, area, row_number() OVER (
    PARTITION BY ip_num ORDER BY end_ip_num - begin_ip_num, begin_ip_num, area, country) AS place
  FROM (SELECT DISTINCT ip_num FROM logs) JOIN nested ON ip_num BETWEEN begin_ip_num AND end_ip_num
)
SELECT event_id, ip, coalesce(a.country, '未知国家') AS geo_country,
       coalesce(a.area, '未知地区') AS geo_area
FROM logs LEFT JOIN (SELECT * FROM addresses WHERE place = 1) a USING (ip_num)"""

_CELL_COLUMNS = [
    "ip", "s_time", "http_host", "en", "ver", "u_ud", "u_mid", "u_sd", "c_time", "l", "b_iev",
    "b_rst", "pl", "tt",
]
_CELLS = """
cells AS (""" + " UNION ALL ".join(
    [f"SELECT row_key, event_id, '{c}' AS \"column\", {c} AS value FROM keyed WHERE {c} IS NOT NULL"
     for c in _CELL_COLUMNS]
    + [f"SELECT row_key, event_id, '{c}', '{v}' FROM keyed"
       for c, v in (("u_nu", "1"), ("sdk", "js"), ("kv_color", "red"))]
) + ")"

_PROVINCE = "CAST(o_custkey % 34 + 1 AS INTEGER)"

_SALES = f"""
sales AS (
  SELECT {_PROVINCE} AS province_id,
         CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS order_price
  FROM orders WHERE o_orderkey % 19 NOT IN (3, 4))"""

_REVENUE = f"""WITH {_SALES}
SELECT province_id, round(sum(order_price), 2) AS total FROM sales GROUP BY province_id"""

_CSV_REVENUE = f"""
SELECT {_PROVINCE} AS province_id, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_orderkey % 23 NOT IN (0, 1, 2, 3, 4, 5) GROUP BY 1"""

_TOP = f"""WITH {_SALES}
SELECT province_id, CAST(count(*) AS BIGINT) AS cnt FROM sales
GROUP BY province_id ORDER BY cnt DESC, province_id LIMIT 10"""

_ROUTED = """
routed AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'alipay' WHEN '2-HIGH' THEN 'weixin'
                              WHEN '3-MEDIUM' THEN 'card' ELSE 'other' END AS sink,
         'C' || o_custkey AS order_id, CAST(o_orderkey % 3 AS INTEGER) AS "partition",
         o_orderkey AS "offset", o_orderdate
  FROM orders)"""

_NEWEST_ROUTED = f"""WITH {_ROUTED}
SELECT sink, order_id, "partition", "offset" FROM (
  SELECT *, row_number() OVER (PARTITION BY sink, order_id
    ORDER BY o_orderdate DESC, "partition" DESC, "offset" DESC) AS rn FROM routed)
WHERE rn = 1"""

_WINDOWS = """
windows AS (
  SELECT make_timestamp(CAST(w * 1000000 AS BIGINT)) AS window_start,
         CAST(user_id % 34 + 1 AS INTEGER) AS province_id, ts
  FROM (SELECT *, (floor(epoch(ts) / 36000) - i) * 36000 AS w
        FROM events, range(2) r(i) WHERE event_type = 'purchase')
  WHERE w + 54000 > epoch(ts)),
counts AS (
  SELECT window_start, province_id, CAST(count(*) AS BIGINT) AS cnt
  FROM windows GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start
                                    ORDER BY cnt DESC, province_id) AS INTEGER) AS rank
  FROM counts)"""

_WINDOW_TEXT = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"


def _stamp(expression: str) -> str:
    return f"strftime(CAST({expression} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')"


_WEEK = "(CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER))"
_MONTH = "date_trunc('month', ts)"

# A third of the users that have one is user 0.
_HOT_USER = """CASE WHEN user_id % 29 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 0 ELSE user_id END"""

_SESSIONS = f"""
WITH visits AS (SELECT 'U' || ({_HOT_USER}) AS "user", ts, event_type = 'view' AS page_view
                FROM events WHERE user_id % 29 > 0),
marked AS (SELECT *, coalesce(ts - lag(ts) OVER w > INTERVAL 6 HOURS, true) AS fresh
           FROM visits WINDOW w AS (PARTITION BY "user" ORDER BY ts)),
placed AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY "user" ORDER BY ts) AS session FROM marked)
SELECT "user", strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000 AS seconds,
       sum(page_view::INT)::BIGINT AS page_views, count(*) AS visits
FROM placed GROUP BY "user", session
"""

_STATES = """
created AS (SELECT o_orderkey AS order_id, o_orderdate AS at, o_orderkey AS k,
                   CAST(o_totalprice AS DECIMAL(18, 2)) AS amount FROM orders),
timed AS (
  SELECT *, CASE WHEN k % 4 = 0 OR k % 9 IN (5, 7) THEN NULL ELSE k % 40 END AS pay_hours,
         CASE WHEN k % 6 = 1 OR k % 8 = 0 THEN 30 END AS refund_hours FROM created),
states AS (
  SELECT order_id, amount, CASE WHEN pay_hours IS NULL THEN 'unpaid'
           WHEN refund_hours >= pay_hours THEN 'refunded' ELSE 'paid' END AS state,
         (pay_hours * 3600)::BIGINT AS seconds_to_pay FROM timed)
"""

_PART_SETS = """RECURSIVE
bought AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem),
held AS (
  SELECT o, [p] AS items, p AS last FROM bought
  UNION ALL
  SELECT held.o, list_append(items, p), p FROM held JOIN bought ON bought.o = held.o AND p > last),
sets AS (SELECT items, count(*) AS n FROM held GROUP BY items HAVING count(*) >= 3)"""

ORACLE_SQL: dict[str, str] = {
    "log_parse": f"""WITH {_LOGS}
SELECT event_id, ip, s_time, http_host, en, ver, u_ud, u_mid, u_sd, c_time, l, b_iev, b_rst, pl, tt,
       'kv_color,sdk,u_nu' AS rest_keys, 'js' AS sdk FROM logs""",
    "log_metrics": """
SELECT CAST(count(*) AS BIGINT) AS loaded,
       CAST(count(*) FILTER (WHERE event_id % 10 NOT IN (0, 1, 2)) AS BIGINT) AS parsed,
       CAST(count(*) FILTER (WHERE event_id % 10 NOT IN (0, 1, 2, 4)
                               AND event_type <> 'error') AS BIGINT) AS known,
       CAST(count(*) FILTER (WHERE event_id % 10 IN (0, 1, 2)) AS BIGINT) AS rejected
FROM events""",
    "log_known_events": f"""WITH {_LOGS}
SELECT en, CAST(CASE en {' '.join(f"WHEN '{a}' THEN {i}" for a, (i, _) in EVENTS.items())} END
                AS INTEGER) AS event_no,
       CASE en {' '.join(f"WHEN '{a}' THEN '{n}'" for a, (_, n) in EVENTS.items())} END
         AS event_name, CAST(count(*) AS BIGINT) AS cnt
FROM known GROUP BY en""",
    "access_log_scan": f"""WITH {_LOGS}
SELECT http_host, CAST(count(*) AS BIGINT) AS lines,
       CAST(count(DISTINCT ip) AS BIGINT) AS addresses
FROM logs GROUP BY http_host""",
    "event_row_key": f"WITH {_LOGS}, {_CRC} SELECT event_id, row_key FROM keyed",
    "log_cells_sorted": f"""WITH {_LOGS}, {_CRC}, {_CELLS}
SELECT row_key, "column", arg_max(value, event_id) AS value FROM cells GROUP BY ALL""",
    "cells_to_rows": f"""WITH {_LOGS}, {_CRC}
SELECT row_key, {', '.join(
    f"arg_max({c}, event_id) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in ("en", "u_sd", "c_time", "pl", "u_mid"))}
FROM keyed GROUP BY row_key""",
    "merged_rows": f"""WITH {_LOGS}, {_CRC}
SELECT row_key, {', '.join(
    f"arg_max({c}, event_id) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in ("en", "ip", "u_sd", "c_time", "pl", "ver", "browser", "os_v"))},
       'red' AS kv_color
FROM keyed GROUP BY row_key""",
    "ip_region": _IP_REGION,
    "ip_region_large": _IP_REGION,
    "ip_region_nested": _IP_REGION_NESTED,
    "ip_region_nested_large": _IP_REGION_NESTED,
    "geo_decompose": f"SELECT c_custkey, {_region('c_custkey % 15', 'c_name')} FROM customer",
    "ip_enrich": f"""WITH {_LOGS}, {_RANGES},
regions AS (SELECT begin_ip_num, end_ip_num, {_region('kind', 'country')} FROM ranges)
SELECT event_id,
       CASE WHEN ip <> '' THEN coalesce(r.country, '未知国家') END AS country,
       CASE WHEN ip <> '' THEN coalesce(r.province, 'unknown') END AS province,
       CASE WHEN ip <> '' THEN coalesce(r.city, 'unknown') END AS city
FROM known LEFT JOIN regions r ON ip_num BETWEEN begin_ip_num AND end_ip_num""",
    "ua_enrich": f"WITH {_LOGS} SELECT event_id, browser, browser_v, os, os_v FROM known",
    "ip_ranges_search": f"""WITH {_RANGES}
SELECT {', '.join(
    " || '.' || ".join(f"(({c}_ip_num >> {s}) & 255)" for s in (24, 16, 8, 0)) + f" AS {c}_ip"
    for c in ("begin", "end"))}, country, area
FROM ranges WHERE contains(country, '市') OR contains(area, '市')""",
    "ip_range_ends": f"""WITH {_RANGES}
SELECT {" || '.' || ".join(f"((end_ip_num >> {s}) & 255)" for s in (24, 16, 8, 0))} AS end_ip
FROM ranges""",
    "ip_address_text": f"""WITH {_RANGES}
SELECT begin_ip_num, trim(CASE WHEN country = ' CZ88.NET' THEN '' ELSE country END || ' '
                          || CASE WHEN area = ' CZ88.NET' THEN '' ELSE area END) AS address
FROM ranges""",
    "ip_numbers": f"""WITH {_LOGS}
SELECT event_id, ip_num, CASE WHEN ip_num IS NOT NULL THEN ip END AS ip_back FROM logs""",
    "daily_events": f"""WITH {_LOGS}
SELECT u_ud, s_time, pl, ver, browser, browser_v FROM known WHERE en = 'e_l'""",
    "snapshot_events": _BY_PLATFORM,
    "log_etl_table": f"""WITH {_LOGS}, {_CRC}
SELECT DISTINCT row_key, en, u_ud, u_mid FROM keyed""",
    "launch_dimensions": f"WITH {_LOGS}, {_LAUNCHES} SELECT * FROM launches",
    "new_users_platform": _BY_PLATFORM,
    "new_users_browser": _BY_BROWSER,
    "new_users_browser_sql": _BY_BROWSER,
    "new_users_result": f"""WITH {_LOGS}, {_LAUNCHES}
SELECT day AS day_dim, platformDimension AS platform_dim, browserDimension AS browser_dim,
       CAST(count(*) AS INTEGER) AS cnt
FROM launches GROUP BY ALL""",
    "upsert_result": """
WITH totals AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1),
updated AS (SELECT o_custkey AS c_custkey, amount FROM totals)
SELECT * FROM updated UNION ALL
SELECT c_custkey, c_acctbal FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM totals WHERE o_custkey = c.c_custkey)""",
    "new_users_rollup": f"""WITH {_LOGS}, {_LAUNCHES},
found AS (SELECT day, platformDimension AS p, nullif(browserDimension, 'unknown:unknown') AS b
          FROM launches),
pairs AS (SELECT day, p, b, count(*) AS n FROM found GROUP BY ALL)
SELECT day, p AS platformDimension, b AS browserDimension, 0::INTEGER AS level, n AS total FROM pairs
UNION ALL SELECT day, p, 'all', 1, sum(n)::BIGINT FROM pairs GROUP BY day, p
UNION ALL SELECT day, 'all', b, 2, sum(n)::BIGINT FROM pairs GROUP BY day, b
UNION ALL SELECT day, 'all', 'all', 3, sum(n)::BIGINT FROM pairs GROUP BY day""",
    "session_metrics": _SESSIONS,
    "session_metrics_stream": _SESSIONS,
    "order_referrer": f"""
WITH buyers AS (SELECT event_id, date_trunc('hour', ts) AS at, {_HOT_USER} AS user_id
                FROM events WHERE event_type = 'purchase'),
referrals AS (SELECT event_id AS tie, date_trunc('hour', ts) AS at, {_HOT_USER} AS user_id,
                     'ref' || event_id % 7 AS value
              FROM events WHERE event_type = 'view' AND event_id % 3 > 0)
SELECT b.event_id, b.user_id, arg_max(value, (r.at, tie)) AS referrer
FROM buyers AS b LEFT JOIN referrals AS r ON r.user_id = b.user_id AND r.at <= b.at
GROUP BY b.event_id, b.user_id""",
    "active_users": f"""
WITH visits AS (SELECT ts::DATE AS day, {_HOT_USER} AS u FROM events),
known AS (SELECT * FROM visits WHERE u IS NOT NULL),
days AS (SELECT DISTINCT day FROM known),
totals AS (SELECT d.day, count(DISTINCT u) AS total FROM days AS d JOIN known AS k ON k.day <= d.day
           GROUP BY d.day),
periods AS (SELECT 'day' AS period, day AS start, * FROM known
            UNION ALL SELECT 'week', date_trunc('week', day), * FROM known
            UNION ALL SELECT 'month', date_trunc('month', day), * FROM known)
SELECT period, strftime(start, '%Y-%m-%d') AS start, count(DISTINCT u) AS active_users,
       max(total)::BIGINT AS total_users
FROM periods JOIN totals USING (day) GROUP BY period, start""",
    "order_states": f"""WITH {_STATES}
SELECT order_id, state, seconds_to_pay FROM states""",
    "order_lifecycle": f"""WITH {_STATES}
SELECT state, count(*) AS orders, sum(amount) AS amount FROM states GROUP BY state
UNION ALL SELECT 'total', count(*), sum(amount) FROM states""",
    "province_revenue": _REVENUE,
    "csv_revenue": _CSV_REVENUE,
    "order_metrics": """
SELECT CAST(count(*) AS BIGINT) AS loaded,
       CAST(count(*) FILTER (WHERE o_orderkey % 19 NOT IN (3, 4)) AS BIGINT) AS accepted,
       CAST(count(*) FILTER (WHERE o_orderkey % 19 IN (3, 4)) AS BIGINT) AS rejected
FROM orders""",
    "top10_provinces": _TOP,
    "top10_provinces_sql": _TOP,
    "route_orders": f"""WITH {_ROUTED}
SELECT sink, CAST(count(*) AS BIGINT) AS messages,
       CAST(count(DISTINCT order_id) AS BIGINT) AS order_ids
FROM routed GROUP BY sink""",
    "put_by_key": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
             l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
    "offset_ledger": f"""
SELECT '{TOPIC}' AS topic, CAST(o_orderkey % 3 AS INTEGER) AS "partition",
       max(o_orderkey) + 1 AS until_offset
FROM orders GROUP BY 2""",
    "saved_offsets": f"""
SELECT '{TOPIC}' AS topic,
       '{{' || string_agg('"' || p || '":' || until_offset, ',' ORDER BY p) || '}}' AS offsets
FROM (SELECT o_orderkey % 3 AS p, max(o_orderkey) + 1 AS until_offset FROM orders GROUP BY 1)""",
    "running_revenue_complete": _REVENUE,
    "running_revenue_update": _REVENUE,
    "stateful_revenue": _CSV_REVENUE,
    "stateful_totals": f"""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE {_PROVINCE} END AS province_id,
       round(sum(o_totalprice), 2) AS total,
       round(sum(CASE WHEN date_trunc('month', o_orderdate) + INTERVAL 400 DAY > newest
                      THEN o_totalprice ELSE 0 END), 2) AS recent
FROM orders, (SELECT max(o_orderdate) AS newest FROM orders) GROUP BY 1""",
    "windowed_order_count": f"""WITH {_WINDOWS}
SELECT {_WINDOW_TEXT}, province_id, cnt FROM counts""",
    "windowed_top10": f"""WITH {_WINDOWS}
SELECT {_WINDOW_TEXT}, province_id, cnt, rank FROM ranked WHERE rank <= 10""",
    "published_top10": f"""WITH {_WINDOWS},
closed AS (SELECT max(window_start) AS newest FROM windows
           WHERE window_start + INTERVAL 15 HOUR <= (SELECT max(ts) FROM windows))
SELECT {_WINDOW_TEXT}, province_id, cnt, rank FROM ranked
WHERE rank <= 10 AND ranked.window_start = (SELECT newest FROM closed)""",
    "routed_tables": _NEWEST_ROUTED,
    "routed_compacted": _NEWEST_ROUTED,
    "routed_metrics": """
SELECT CAST(count(*) AS BIGINT) AS received,
       CAST(count(*) FILTER (WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0) AS BIGINT)
         AS stored,
       CAST(count(*) FILTER (WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0) AS BIGINT)
         AS rejected
FROM orders""",
    "date_parts": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(quarter(o_orderdate) AS INTEGER) AS season,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(week(o_orderdate) AS INTEGER) AS week,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(hour(o_orderdate) AS INTEGER) AS hour
FROM orders""",
    "date_starts": f"""
SELECT event_id, {_stamp(_WEEK)} AS week, {_stamp(_MONTH)} AS month,
       {_stamp(f"{_MONTH} - INTERVAL 1 MONTH")} AS previous_month,
       {_stamp(f"{_MONTH} + INTERVAL 1 MONTH")} AS next_month,
       {_stamp(f"{_WEEK} - 7")} AS previous_week,
       {_stamp(f"{_WEEK} + 7")} AS next_week,
       {_stamp(f"{_MONTH} - INTERVAL 1 MONTH + to_hours(hour(ts))")} AS previous_month_hour,
       {_stamp(f"{_WEEK} + 7 + to_hours(hour(ts))")} AS next_week_hour,
       {_stamp("CAST(ts AS DATE) - 10")} AS ten_days_back
FROM events""",
    "date_texts": """
SELECT o_orderkey, epoch_ms(o_orderdate) AS millis,
       strftime(o_orderdate + INTERVAL 1 DAY, '%Y/%m/%d 00:00') AS next_day,
       strftime(o_orderdate, '%Y%m%d') AS suffix
FROM orders""",
    "order_age": """
SELECT o_orderkey,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), current_date) AS INTEGER) AS days_to_today,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), current_date) - 1 AS INTEGER)
         AS days_to_yesterday
FROM orders""",
    "server_times": f"""WITH {_LOGS}
SELECT event_id, s_millis AS millis,
       CASE WHEN s_time <> 'n/a'
            THEN strftime(make_timestamp(s_millis * 1000), '%Y-%m-%d %H:%M:%S') END AS "at"
FROM logs""",
    "running_dates": """
SELECT o_orderkey, o_orderkey % 5 = 4 AS valid, o_orderkey % 5 IN (1, 3) AS blank FROM orders""",
    "frequent_parts": f"""WITH {_PART_SETS}
SELECT array_to_string(items, ' ') AS parts, CAST(len(items) AS INTEGER) AS n_parts, n AS n_orders
FROM sets""",
    "part_rules": f"""WITH {_PART_SETS}, cut AS (
  SELECT n, x, list_filter(items, lambda y: y <> x) AS rest
  FROM (SELECT n, items, unnest(items) AS x FROM sets WHERE len(items) > 1))
SELECT array_to_string(rest, ' ') AS antecedent, CAST(x AS VARCHAR) AS consequent,
       cut.n / sets.n AS confidence
FROM cut JOIN sets ON sets.items = rest WHERE cut.n / sets.n >= 0.1""",
}
