import datetime as dt
import os
import zlib

from pyspark.sql import functions as F

from clickweir.operators import analytics, logs, shaping
from clickweir.plans import log_etl
from clickweir.sources import logs as log_sources

SAMPLE = (
    "198.51.100.23^A1700000000.125^Ashop.example.org^A/beacon.png?en=e_l&pl=website&ver=2"
    "&u_ud=visitor-7&u_sd=session-42&c_time=1699999999000&l=fr-FR&b_rst=800*600&u_nu=1&sdk=js"
    "&trace=abc&b_iev=Mozilla%2F5.0%20(X11%3B%20Linux%20x86_64%3B%20rv%3A99.0)%20"
    "Gecko%2F20100101%20Firefox%2F99.0"
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def params(one_row, *uris):
    return one_row(list(uris), logs.parse_uri_params)


def test_sample_line(spark):
    parsed = logs.event_attributes(logs.parse_event(logs.split_log_line(lines(spark, SAMPLE))))
    attrs = parsed.first().attrs
    assert len(attrs) == 3 + 12
    assert attrs["ip"] == "198.51.100.23" and attrs["s_time"] == "1700000000.125"
    assert attrs["b_iev"].endswith("Gecko/20100101 Firefox/99.0")
    row = log_etl.parse_lines(lines(spark, SAMPLE)).first()
    assert row.en == "e_l" and row.pl == "website" and row.tt is None
    assert set(row.attrs) == {"u_nu", "sdk", "trace"}


def test_field_counts(spark):
    given = ["", "  ", "a^Ab^Ac", "a^Ab^Ac^Ad^Ae", "a^Ab^Ac^Ad", "a^Ab^Ac^Ad^A^A", "a^Ab^Ac^A",
             "^Ab^Ac^Ad", "a\x01b\x01c\x01d", None]
    rows = logs.split_log_line(lines(spark, *given)).collect()
    assert [tuple(r) for r in rows] == [
        ("a", "b", "c", "d"), ("a", "b", "c", "d"), ("", "b", "c", "d")
    ]


def test_uri_needs_exactly_one_question_mark(one_row):
    assert params(one_row, "/x", "/x?", "/x?a=1", "/x?a=1?", "/x?a=1?b=2", "?a=1", "", None) == [
        {}, {}, {"a": "1"}, {"a": "1"}, {}, {"a": "1"}, {}, {}
    ]


def test_parameter_rules(one_row):
    assert params(one_row, "/x?a=1&b&c=&d==&=e&&f=%E4%B8%AD+x&g=%zz&h=1=2&i==3&a=2&j=%4&k%20=%20")[
        0
    ] == {"": "e", "f": "中 x", "h": "1", "i": "", "a": "2", "k%20": " "}
    # Only the value's own escapes matter, and a broken repeat does not hide a good one.
    assert params(one_row, "/x?a%zz=1&b=2=%zz&c=3&c=%zz")[0] == {"a%zz": "1", "b": "2", "c": "3"}


def test_parameter_may_replace_header(spark):
    line = "1.2.3.4^A10.5^Ah^A/x?en=e_l&ip=9.9.9.9&s_time=20.5"
    row = log_etl.parse_lines(lines(spark, line)).first()
    assert (row.ip, row.s_time, row.http_host, row.client_ip) == ("9.9.9.9", "20.5", "h", "1.2.3.4")


def test_known_events_only(spark):
    given = [f"i^At^Ah^A/x?en={en}" for en in ("e_l", "e_pv", "e_crt", "e_cs", "e_cr", "e_e")]
    given += ["i^At^Ah^A/x?en=e_bad", "i^At^Ah^A/x?a=1", "i^At^Ah^A/x?en=e%5Fl", "i^At^Ah^A/x"]
    kept = log_etl.parse_lines(lines(spark, *given)).select("en").collect()
    assert [r.en for r in kept] == ["e_l", "e_pv", "e_crt", "e_cs", "e_cr", "e_e", "e_l"]


def test_row_key(spark):
    frame = spark.createDataFrame(
        [("1700000000.125", "u", " ", "e_l"), ("x", None, "m", "e_l")],
        "s_time string, u_ud string, u_mid string, en string",
    )
    keys = [r.row_key for r in logs.with_row_key(frame).collect()]
    assert keys == [f"1700000000125_{zlib.crc32(b'ue_l')}", f"-1_{zlib.crc32(b'me_l')}"]


def test_cells_round_trip(spark):
    events = logs.with_row_key(log_etl.parse_lines(lines(spark, SAMPLE)))
    cells = logs.to_cells(events)
    assert cells.count() == 3 + 12
    row = logs.from_cells(cells, ["en", "sdk", "tt"]).first()
    assert (row.en, row.sdk, row.tt) == ("e_l", "js", None)


def test_log_metrics(spark):
    bad = ["", "a^Ab", "i^At^Ah^A/x?en=e_bad"]
    assert shaping.log_metrics(lines(spark, SAMPLE, *bad)).first().asDict() == {
        "loaded": 4, "parsed": 2, "known": 1, "rejected": 2
    }


def test_observed_metrics_need_no_job(spark):
    counted, seen = shaping.with_metrics(
        lines(spark, SAMPLE, ""), "loaded", blank=F.count_if(F.col("value") == "")
    )
    counted.collect()
    assert seen.get == {"rows": 2, "blank": 1}


def test_dimensions(spark):
    given = [
        ("u", "1700000000.125", None, "1", None, "9"),
        ("u", "1700000000.125", "website", " ", "Chrome", ""),
        ("u", "x", "website", "1", "Chrome", "52.0.2743.82"),
        ("", "", "w", "1.2", "IE", "9"),
        (None, "1700000000.125", "w", "1", "IE", "9"),
        ("u", None, "w", "1", "IE", "9"),
    ]
    frame = spark.createDataFrame(
        given, "u_ud string, s_time string, pl string, ver string, browser string, browser_v string"
    )
    rows = [tuple(r)[1:] for r in analytics.launch_dimensions(frame).collect()]
    assert rows == [
        (14, "unknown:unknown", "unknown:unknown"),
        (14, "website:unknown", "Chrome:unknown"),
        (31, "website:1", "Chrome:52"),
        (31, "w:1.2", "IE:9"),
    ]


def test_new_users_are_rows_not_distinct_users(spark):
    frame = spark.createDataFrame(
        [("u", 1, "w:1", "IE:9")] * 3,
        "uuid string, day int, platformDimension string, browserDimension string",
    )
    assert analytics.new_users_by_platform(frame).first().total == 3
    assert analytics.new_users_by_browser(frame).first().total == 3
    assert analytics.new_users_by_browser_sql(frame).first().total == 3


def test_zone_is_a_parameter(spark):
    from clickweir.session import configure

    frame = spark.createDataFrame([("1700000000.125",)], "s_time string")
    try:
        configure(spark, "Asia/Tokyo")
        assert frame.select(analytics.day_dim(F.col("s_time"))).first()[0] == 15
    finally:
        configure(spark)
    assert dt.datetime.fromtimestamp(1700000000, dt.UTC).day == 14


def test_ingestion_order_follows_files_not_their_sizes(spark, tmp_path):
    day = tmp_path / "2024-01-31"
    day.mkdir()
    (day / "a.log").write_text("small\n")
    (day / "b.log").write_text("".join(f"line {i}\n" for i in range(2000)))
    for name, seconds in (("a.log", 100), ("b.log", 200)):
        os.utime(day / name, (seconds, seconds))
    expected = ["small", *[f"line {i}" for i in range(2000)]]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for split in ("700", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            read = log_sources.read_access_logs(spark, str(tmp_path), "2024-01-31")
            rows = read.orderBy("ingest_order").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [r.value for r in rows] == expected


def test_system_rules_are_pruned_where_only_browsers_are_read(spark):
    from clickweir.operators import enrich

    events = enrich.enrich_user_agent(lines(spark, "x").withColumnRenamed("value", "b_iev"))
    plan = events.select("browser")._jdf.queryExecution().optimizedPlan().toString()
    assert "Windows NT 6.1" not in plan and "Chrome/" in plan
