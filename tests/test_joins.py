import random

import pytest
from conftest import physical_plan
from pyspark.sql import functions as F

from clickweir.functions.network import ip_to_long
from clickweir.operators import enrich, joins

RANGES = [
    # begin, end, country, area: narrow, adjacent, wide over many buckets, with gaps
    ("0.0.0.0", "0.255.255.255", "reserved", "x"),
    ("10.0.0.0", "10.0.0.0", "one", "x"),
    ("10.0.0.1", "10.0.0.255", "narrow", "x"),
    ("10.0.1.0", "10.0.255.255", "adjacent", "x"),
    ("10.1.128.0", "10.9.127.255", "wide", "x"),
    ("10.9.200.0", "10.9.200.7", "北京市海淀区", "x"),
    ("223.255.255.0", "255.255.255.255", "last", " CZ88.NET"),
]


def number(ip):
    a, b, c, d = map(int, ip.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


@pytest.fixture(scope="module")
def ranges(spark):
    rows = [(number(b), number(e), c, a) for b, e, c, a in RANGES]
    return spark.createDataFrame(
        rows, "begin_ip_num long, end_ip_num long, country string, area string"
    )


@pytest.fixture(scope="module")
def addresses(spark):
    pick = random.Random(7)
    values = [ip for b, e, *_ in RANGES for ip in (b, e)]
    values += [f"10.{pick.randrange(12)}.{pick.randrange(256)}.{pick.randrange(256)}"
               for _ in range(300)]
    # One address holds a third of the rows, as exact copies.
    values += ["10.0.0.9"] * 200 + ["", "10.0.0", "bad", None, "10.1.0.0", "10.9.127.255"]
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, ip string")


def expected(ip):
    try:
        n = number(ip)
    except (ValueError, AttributeError):
        return "未知国家"
    return next((c for b, e, c, _ in RANGES if number(b) <= n <= number(e)), "未知国家")


@pytest.mark.parametrize("limits", [
    {}, {"max_bytes": 0}, {"max_per_bucket": 0},
])
def test_ip_range_join_equals_brute_force(addresses, ranges, limits):
    joined = enrich.ip_range_join(addresses, ranges, **limits)
    got = {r.i: (r.ip, r.geo_country) for r in joined.collect()}
    assert joined.count() == addresses.count()
    assert all(country == expected(ip) for ip, country in got.values())


def test_small_dictionary_is_broadcast_on_the_bucket(addresses, ranges):
    plan = physical_plan(enrich.ip_range_join(addresses, ranges))
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_large_dictionary_is_not_joined_pairwise(addresses, ranges):
    plan = physical_plan(enrich.ip_range_join(addresses, ranges, max_bytes=0))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "Window" in plan


def test_crowded_bucket_is_exact(spark):
    rows = [(167772160 + 2 * i, 167772160 + 2 * i, str(i), "x") for i in range(3000)]
    ranges = spark.createDataFrame(
        rows, "begin_ip_num long, end_ip_num long, country string, area string"
    )
    points = spark.range(3000).select(
        F.concat(F.lit("10.0."), F.shiftright("id", 8).cast("string"), F.lit("."),
                 F.col("id").bitwiseAND(255).cast("string")).alias("ip")
    )
    joined = enrich.ip_range_join(points, ranges)
    found = joined.withColumn("n", ip_to_long(F.col("ip")) - 167772160)
    assert "Window" in physical_plan(joined)
    wrong = found.where(
        F.col("geo_country")
        != F.when(F.col("n") % 2 == 0, F.floor(F.col("n") / 2).cast("string")).otherwise("未知国家")
    )
    assert found.count() == 3000 and wrong.count() == 0


def test_enrich_ip_fills_only_what_is_known(spark, ranges):
    events = spark.createDataFrame(
        [("10.9.200.1", None, "p"), ("", "c", "p"), ("bad", "c", None), ("10.0.0.0", None, None)],
        "client_ip string, country string, province string",
    )
    rows = {r.client_ip: (r.country, r.province, r.city)
            for r in enrich.enrich_ip(events, ranges).collect()}
    assert rows == {
        "10.9.200.1": ("中国", "北京市", "海淀区"),
        "": ("c", "p", None),
        "bad": ("未知国家", "unknown", "unknown"),
        "10.0.0.0": ("one", "unknown", "unknown"),
    }


def test_agent_of_the_event_beats_its_parameters(spark):
    events = spark.createDataFrame(
        [("x MSIE 9.0; Windows NT 6.1", "param"), (None, "param")], "b_iev string, browser string"
    )
    rows = enrich.enrich_user_agent(events).collect()
    assert [(r.browser, r.browser_v) for r in rows] == [("IE", "9.0"), ("param", None)]


def test_overlapping_ranges_are_found(spark, ranges):
    assert joins.overlapping_ranges(ranges, "begin_ip_num", "end_ip_num").isEmpty()
    extra = spark.createDataFrame(
        [(number("10.3.0.0"), number("10.3.0.5"), "inside", "x")], ranges.schema
    )
    found = joins.overlapping_ranges(ranges.union(extra), "begin_ip_num", "end_ip_num").collect()
    assert "inside" in {r.country for r in found}


def test_search_and_ends(ranges):
    assert [tuple(r) for r in enrich.search_ip_ranges(ranges, "海淀").collect()] == [
        ("10.9.200.0", "10.9.200.7", "北京市海淀区", "x")
    ]
    assert enrich.search_ip_ranges(ranges, "CZ88").count() == 1
    ends = {r.end_ip for r in enrich.list_ip_ends(ranges).collect()}
    assert ends == {e for _, e, *_ in RANGES}


def test_bounded_broadcast(spark):
    small = spark.range(10)
    facts = spark.range(100)
    assert "BroadcastHashJoin" in physical_plan(
        facts.join(joins.bounded_broadcast(small), "id", "left_semi")
    )
    assert joins.bounded_broadcast(small, 9) is small


@pytest.mark.parametrize("limits", [{}, {"max_bytes": 0}, {"max_per_bucket": 0}])
def test_nested_and_repeated_ranges_give_the_narrowest(spark, limits):
    pick = random.Random(3)
    base = number("10.0.0.0")
    rows = [(base, base + (1 << 18), "outer", "x"), (base + 10, base + 20, "inner", "x"),
            (base + 10, base + 20, "twin", "x"), (base + 5, base + 15, "left", "x")]
    for i in range(60):
        begin = base + pick.randrange(1 << 18)
        rows.append((begin, begin + pick.choice([0, 3, 70_000]), f"r{i}", "x"))
    ranges = spark.createDataFrame(
        rows, "begin_ip_num long, end_ip_num long, country string, area string")
    points = sorted({p for b, e, *_ in rows for p in (b - 1, b, e, e + 1)})
    texts = [".".join(str(p >> s & 255) for s in (24, 16, 8, 0)) for p in points]
    frame = spark.createDataFrame([(t,) for t in texts], "ip string")
    found = {r.ip: r.geo_country for r in enrich.ip_range_join(frame, ranges, **limits).collect()}
    for p, t in zip(points, texts):
        holding = sorted((e - b, b, c) for b, e, c, _ in rows if b <= p <= e)
        assert found[t] == (holding[0][2] if holding else "未知国家"), t
    assert len(found) == len(points)


def test_crowded_bucket_of_overlapping_ranges(spark):
    """A third of the ranges in one /16, many texts for one extent, no Python on the way."""
    pick = random.Random(9)
    base = number("10.7.0.0")
    crowd = [(base + a, min(base + a + pick.choice([0, 1, 6, 300, 9000]), base + 65535))
             for a in (pick.randrange(65536) for _ in range(1500))]
    rows = [(b, e, f"c{i}", "x") for i, (b, e) in enumerate(crowd)]
    rows += [(base, base + 65535, f"t{i:04d}", "x") for i in range(1500)]
    rows += [(0, 2 ** 32 - 1, "all", "x"), (2 ** 31, 2 ** 32 - 1, "half", "x"),
             (base + 9, base + 3, "reversed", "x"), (None, base, "null", "x"),
             (base, None, "open", "x"), (base, 2 ** 32, "beyond", "x")]
    ranges = spark.createDataFrame(
        rows, "begin_ip_num long, end_ip_num long, country string, area string")
    pieces = joins.disjoint_ranges(ranges, "begin_ip_num", "end_ip_num")
    plan = physical_plan(pieces)
    assert "Arrow" not in plan and "Python" not in plan and "NestedLoop" not in plan
    assert joins.overlapping_ranges(pieces, "_from", "_to").isEmpty()
    points = [0, 2 ** 31 - 1, 2 ** 31, 2 ** 32 - 1, base - 1, base + 65536]
    points += [base + pick.randrange(65536) for _ in range(300)]
    texts = {".".join(str(p >> s & 255) for s in (24, 16, 8, 0)): p for p in points}
    frame = spark.createDataFrame([(t,) for t in texts], "ip string")
    whole = [(e - b, b, c) for b, e, c, _ in rows
             if b is not None and e is not None and b <= e < 2 ** 32]
    for limits in ({}, {"max_bytes": 0}):
        found = enrich.ip_range_join(frame, ranges, **limits).collect()
        assert len(found) == len(texts)
        for r in found:
            p = texts[r.ip]
            assert r.geo_country == min((w, b, c) for w, b, c in whole if b <= p <= b + w)[2]


def test_prefixes_make_up_their_range(spark):
    pick = random.Random(2)
    spans = [(0, 2 ** 32 - 1), (5, 5), (1, 2 ** 32 - 2), (2 ** 31, 2 ** 32 - 1)]
    spans += [tuple(sorted(pick.randrange(2 ** 32) for _ in range(2))) for _ in range(30)]
    for b, e in spans[:4] + spans[4::6]:
        frame = spark.createDataFrame([(b, e)], "b long, e long")
        cut = sorted(((r[0] & (2 ** 33 - 1)) << (r[0] >> 33), 1 << (r[0] >> 33))
                     for r in joins.covering_prefixes(frame, "b", "e").collect())
        assert cut[0][0] == b and cut[-1][0] + cut[-1][1] == e + 1 and len(cut) <= 62
        assert all(x + n == y for (x, n), (y, _) in zip(cut, cut[1:]))
