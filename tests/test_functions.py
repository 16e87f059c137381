import datetime as dt
import zlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clickweir.functions import agents, dates, geo, network, text


def test_blank(one_row):
    values = [None, "", " ", "\t\n", "　", "a", " a "]
    assert one_row(values, text.is_blank) == [True] * 5 + [False] * 2
    assert one_row([" ", "a"], text.blank_to_null) == [None, "a"]


def test_major_version(one_row):
    assert one_row(["52.0.2743.82", "9", "", ".5", None], text.major_version) == [
        "52", "9", "", "", None
    ]


def test_crc32_concatenates_present_parts(spark):
    row = spark.range(1).select(
        text.crc32_of(F.lit("用户"), F.lit(None).cast("string"), F.lit("e_l")).alias("crc")
    ).first()
    assert row.crc == zlib.crc32("用户e_l".encode())


def test_event_names(one_row):
    assert one_row(["e_l", "e_e", "e_x", None], text.event_id) == [1, 6, None, None]
    assert one_row(["e_cr"], text.event_name) == ["charge refund event"]


def test_ip_numbers(one_row):
    values = ["0.0.0.0", "10.1.2.3", "255.255.255.255", "256.1.1.1", "1.2.3", "1.2.3.4.5", "a.b.c.d",
              "", "1..2.3", None]
    numbers = one_row(values, network.ip_to_long)
    assert numbers == [0, 167838211, 4294967295] + [None] * 7
    assert one_row([0, 167838211, 4294967295, None], network.long_to_ip, "bigint") == [
        "0.0.0.0", "10.1.2.3", "255.255.255.255", None
    ]


def test_address_text(one_row):
    build = lambda c: network.address_text(c, F.lit("电信"))
    assert one_row(["上海市", " CZ88.NET"], build) == ["上海市 电信", "电信"]


@pytest.mark.parametrize("value, expected", [
    ("广东省深圳市", ("中国", "广东省", "深圳市")),
    ("江苏省", ("中国", "江苏省", "unknown")),
    ("浙江省市场", ("中国", "浙江省", "市")),
    ("省委", ("省委", "unknown", "unknown")),
    ("内蒙古赤峰市", ("中国", "内蒙古自治区", "赤峰市")),
    ("内蒙古", ("中国", "内蒙古自治区", "unknown")),
    ("内蒙", ("中国", "内蒙古自治区", "unknown")),
    ("广西南宁市", ("中国", "广西", "南宁市")),
    ("西藏", ("中国", "西藏", "unknown")),
    ("北京市海淀区", ("中国", "北京市", "海淀区")),
    ("北京", ("中国", "北京市", "unknown")),
    ("重庆市忠县", ("中国", "重庆市", "忠县")),
    ("天津市区县", ("中国", "天津市", "区县")),
    ("香港", ("中国", "香港特别行政区", "unknown")),
    ("澳门特别行政区", ("中国", "澳门特别行政区", "unknown")),
    ("局域网", ("中国", "上海市", "unknown")),
    ("  CZ88.NET", ("中国", "上海市", "unknown")),
    ("", ("中国", "上海市", "unknown")),
    (None, ("中国", "上海市", "unknown")),
    ("美", ("unknown", "unknown", "unknown")),
    ("美国", ("美国", "unknown", "unknown")),
    ("未知国家", ("未知国家", "unknown", "unknown")),
])
def test_region_rules(one_row, value, expected):
    assert tuple(one_row([value], geo.region_of)[0]) == expected


@pytest.mark.parametrize("agent, browser, system", [
    ("Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/51.0 Safari/537.36 Edge/14.14393",
     ("Edge", "14.14393"), ("Windows", "Windows 10")),
    ("Mozilla/5.0 (Windows NT 6.3) Chrome/46.0 Safari/537.36 OPR/33.0.1990.58",
     ("Opera", "33.0.1990.58"), ("Windows", "Windows 8.1")),
    ("Opera/9.80 (Windows NT 6.0) Presto/2.12.388 Version/12.14",
     ("Opera", "12.14"), ("Windows", "Windows Vista")),
    ("Opera/8.5 (X11; Linux i686)", ("Opera", "8.5"), ("Linux", "Linux")),
    ("Mozilla/5.0 (Windows NT 6.2; Trident/7.0; rv:11.0) like Gecko",
     ("IE", "11.0"), ("Windows", "Windows 8")),
    ("Mozilla/5.0 (Linux; Android 5.1.1; Nexus 5) Chrome/46.0.2490.76 Mobile Safari/537.36",
     ("Chrome", "46.0.2490.76"), ("Android", "Android 5.1")),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_10_5) Version/9.0 Safari/601.1",
     ("Safari", "9.0"), ("OS X", "OS X 10.10")),
    ("curl/7.43.0", ("unknown", None), ("unknown", "unknown")),
])
def test_agents(one_row, agent, browser, system):
    assert tuple(one_row([agent], agents.browser_of)[0]) == browser
    assert tuple(one_row([agent], agents.system_of)[0]) == system


def test_blank_agent_has_no_facts(one_row):
    assert one_row([None, " "], agents.browser_of) == [None, None]
    assert one_row([None, " "], agents.system_of) == [None, None]


def test_server_time(one_row):
    values = ["1449410796.976", " 1450569601.351 ", "1", "x", "", None, "NaN", "1e300"]
    assert one_row(values, dates.server_time_millis) == [
        1449410796976, 1450569601351, 1000, -1, -1, -1, -1, -1
    ]
    at = one_row(values, lambda c: F.date_format(dates.server_time(c), "yyyy-MM-dd HH:mm:ss"))
    assert at[0] == "2015-12-06 14:06:36" and at[3:] == [None] * 5


def test_running_date(one_row):
    values = ["2015-12-20", "2015-1-20", "20151220", "2015-12-20 ", "x2015-12-20", "2015-12-20\n",
              "", None]
    assert one_row(values, dates.is_valid_running_date) == [True] + [False] * 7


def test_text_and_millis(one_row):
    assert one_row(["2015-12-20"], dates.text_to_millis) == [1450569600000]
    assert one_row(["20/12/2015"], lambda c: dates.text_to_millis(c, "dd/MM/yyyy")) == [
        1450569600000
    ]
    assert one_row([1450569601351], dates.millis_to_text, "bigint") == ["2015-12-20"]
    with pytest.raises(PySparkException):
        one_row(["soon"], dates.text_to_millis)
    assert one_row(["2015-12-20"], dates.day_suffix) == ["20151220"]


def test_date_parts(one_row):
    at = ["2016-01-01 23:15:00"]
    parts = {p: one_row(at, lambda c, p=p: dates.date_part(c.cast("timestamp"), p))[0]
             for p in ("year", "season", "month", "week", "day", "hour")}
    assert parts == {"year": 2016, "season": 1, "month": 1, "week": 53, "day": 1, "hour": 23}
    with pytest.raises(ValueError):
        dates.date_part(F.lit(None), "minute")


def test_starts_of_periods(one_row):
    def at(build, value="2016-03-16 10:20:30"):
        return one_row([value], lambda c: build(c.cast("timestamp")))[0]

    assert at(dates.first_day_of_week) == dt.datetime(2016, 3, 13)
    assert at(dates.first_day_of_week, "2016-03-13 01:00:00") == dt.datetime(2016, 3, 13)
    assert at(dates.first_day_of_month) == dt.datetime(2016, 3, 1)
    assert at(dates.first_day_of_previous_month) == dt.datetime(2016, 2, 1)
    assert at(dates.first_day_of_next_month) == dt.datetime(2016, 4, 1)
    assert at(lambda c: dates.first_day_of_next_month(c, keep_hour=True)) == dt.datetime(
        2016, 4, 1, 10
    )
    assert at(dates.first_day_of_previous_week) == dt.datetime(2016, 3, 6)
    assert at(lambda c: dates.first_day_of_previous_week(c, keep_hour=True)) == dt.datetime(
        2016, 3, 6, 10
    )
    assert at(dates.first_day_of_next_week) == dt.datetime(2016, 3, 20)
    assert at(lambda c: dates.plus_days(c, -16)) == dt.datetime(2016, 2, 29)


def test_relative_days(spark):
    row = spark.range(1).select(
        dates.yesterday().alias("y"), dates.yesterday("yyyyMMdd").alias("s"),
        dates.today().alias("t"), dates.batch_time().alias("b"),
        dates.batch_time(dates.BATCH_TIME_MILLIS_FORMAT).alias("m"),
    ).first()
    assert (row.t - dt.timedelta(days=1)).strftime("%Y-%m-%d") == row.y
    assert row.s == row.y.replace("-", "")
    assert len(row.b) == 19 and len(row.m) == 23
