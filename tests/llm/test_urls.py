import pytest
from conftest import SF_DIR
from helpers import compare

from clickweir.llm import urls

PAGES = "page_id long, url string, host string, verdict int"
OUTCOMES = "page_id long, bad int"


def judge(spark, pages, outcomes, **options):
    frame = spark.createDataFrame([(i, u, "clash", 5) for i, u in pages], PAGES)
    labels = spark.createDataFrame(outcomes, OUTCOMES)
    return {r["page_id"]: r for r in urls.filter_urls(frame, labels, **options).collect()}


def test_query_equals_oracle(spark):
    compare(spark, "op6_url_filters", SF_DIR)


def test_rules_hosts_and_paths(spark):
    pages = {
        1: "https://A.Example.NET/en/x?q#f", 2: "https://example.net/de/", 3: "http://x.net",
        4: "http://b.org/fr/1", 5: "http://example.com/de/1", 6: "http://badexample.com/de/1",
        7: None, 8: "no scheme", 9: "http://planet/", 10: "a\nb://h.net/\n?x", 11: "http://",
    }
    found = judge(spark, pages.items(), [])
    assert {i: (r["host"], r["path"], r["rule"], r["verdict"]) for i, r in found.items()} == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        2: ("example.net", "/de/", "net/", "block"), 3: ("x.net", "", None, "allow"),
        4: ("b.org", "/fr/1", "org/fr/", "allow"),
        5: ("example.com", "/de/1", "example.com/de/", "block"),
        6: ("badexample.com", "/de/1", None, "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("planet", "/", None, "allow"),
        10: ("h.net", "/\n", "net/", "block"), 11: ("", "", None, "allow"),
    }


def test_reputation_shrinks_from_host_to_domain(spark):
    pages, outcomes, i = [], [], 0
    for host, n, bad in [("a.bad.com", 40, 40), ("b.bad.com", 40, 38), ("new.bad.com", 1, None),
                         ("a.good.com", 60, 0), ("once.good.com", 1, 1), ("w.fine.org", 80, 1)]:
        for j in range(n):
            pages.append((i, f"http://{host}/{j}"))
            if bad is not None:
                outcomes += [(i, int(j < bad))] * (1 + j % 2)  # repeated outcomes count once
            i += 1
    found = {r["host"]: r for r in judge(spark, pages, outcomes).values()}
    verdicts = {h: r["verdict"] for h, r in found.items()}
    assert verdicts["a.bad.com"] == verdicts["b.bad.com"] == "block"
    assert verdicts["a.good.com"] == verdicts["w.fine.org"] == verdicts["once.good.com"] == "allow"
    assert found["new.bad.com"]["bad_low"] > found["once.good.com"]["bad_low"]
    assert found["a.bad.com"]["bad_low"] < 1


def test_empty_table_and_long_rule_lists(spark):
    assert judge(spark, [], []) == {}
    many = tuple(urls.UrlRule("block", f"h{i}.com/") for i in range(urls.MAX_RULES + 1))
    with pytest.raises(ValueError):
        judge(spark, [(1, "http://a.b/")], [], rules=many)
