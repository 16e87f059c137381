import base64
import hashlib
import random

import pytest
from conftest import SF_DIR
from helpers import compare

from clickweir.llm import warc
from clickweir.llm.scratch import Scratch

SCHEMA = "page_id long, url string, html string, key string, value int"
FAKE = ("x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\n"
        "Content-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nContent-Length: 99999999999999\r\n\r\n")


@pytest.fixture
def scratch(spark):
    own = Scratch(spark, "warc-test")
    yield own
    own.close()


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def check(spark, pages, min_bytes=0):
    frame = spark.createDataFrame([(i, u, h, "k", 1) for i, u, h in pages], SCHEMA)
    found = {int(r["key"]): r for r in warc.round_trip(frame, min_bytes=min_bytes).collect()}
    assert len(found) == len(pages)
    largest = {}
    for i, _, html in pages:
        largest[html or ""] = max(i, largest.get(html or "", i))
    for i, _, html in pages:
        text = html or ""
        r, size = found[i], len(text.encode())
        holder = largest[text] if size >= min_bytes else i
        assert (r["payload_bytes"], r["payload_digest"]) == (size, digest(text)), i
        assert r["header_digest"] == digest(text)
        assert r["record_type"] == ("response" if holder == i else "revisit")
        assert r["refers_to"] == (None if holder == i else str(holder))
    return found


def test_query_equals_oracle(spark):
    compare(spark, "op1_warc", SF_DIR)


def test_nulls_copies_magic_and_line_ends(spark):
    pages = [(1, None, None), (2, "u", ""), (3, "http://a/\r\nX: y", "é€"), (4, "u", "é€"),
             (5, "u", FAKE), (6, "u", FAKE * 3 + "tail"), (7, "WARC/1.0", "\r\n\r\nWARC/1.0"),
             (8, "u", "\n\r\nWARC/1.0\r"), (9, "u", "z" * 300_000), (10, "u", FAKE)]
    found = check(spark, pages)
    assert found[1]["url"] is None and found[3]["url"] == "http://a/%0D%0AX: y"


def test_small_copies_are_stored_again(spark):
    check(spark, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], 4)


@pytest.mark.parametrize("split", [97, 1000])
def test_small_splits_and_random_magic(spark, split):
    rng = random.Random(split)
    parts = ["\r\n\r\n", "WARC/1.0", "\r\n", "\n", "\r", "text ", FAKE, "é", "Content-Length: 5"]
    pages = [(i, "u", "".join(rng.choice(parts) for _ in range(rng.randrange(12))))
             for i in range(60)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        check(spark, pages)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_scans_that_split_the_archive_differently(spark, monkeypatch):
    rng = random.Random(5)
    pages = [(i, "u", f"page {i} " + FAKE * (i % 3) + "y" * rng.randrange(300))
             for i in range(90)]
    name = "spark.sql.files.maxPartitionBytes"
    before, rejoined, sizes = spark.conf.get(name), warc._rejoined, []

    def other_splits(*args):
        sizes.append(spark.conf.get(name))
        spark.conf.set(name, 5000)
        return rejoined(*args)

    monkeypatch.setattr(warc, "_rejoined", other_splits)
    try:
        check(spark, pages)
    finally:
        spark.conf.set(name, before)
    assert sizes == [before]


def test_truncated_file_keeps_whole_records(spark, scratch, tmp_path):
    frame = spark.createDataFrame([(1, "u", "one"), (2, "u", "two")], "page_id long, url string, "
                                  "html string").coalesce(1)
    warc.write_archive(frame, f"{tmp_path}/a")
    [file] = (tmp_path / "a").glob("part-*")
    data = file.read_bytes()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "cut.warc").write_bytes(data[:-6])
    found = warc.read_archive(spark, f"{tmp_path}/b", scratch).collect()
    assert [r["key"] for r in found] == ["1"]


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_null_and_repeated_keys(spark):
    rows = [(None, "u", "same", "k", 1), (None, None, None, "k", 1), (3, "u", "same", "k", 1),
            (3, "u", "same", "k", 1), (3, "u", "other", "k", 1), (2, "u", "same", "k", 1)]
    found = warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["key"] or "", r["record_type"], r["payload_bytes"], r["payload_digest"])
                  for r in found) == sorted([
                      ("", "response", 4, digest("same")), ("", "response", 0, digest("")),
                      ("2", "revisit", 4, digest("same")), ("3", "response", 4, digest("same")),
                      ("3", "response", 4, digest("same")), ("3", "response", 5, digest("other"))])


def test_repeated_keys_that_hold_nothing(spark):
    rows = [(1, "u", "same", "k", 1)] * 3 + [(1, "u", "other", "k", 1), (2, "u", "same", "k", 1)]
    found = warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["key"], r["record_type"], r["refers_to"] or "", r["payload_bytes"],
                   r["payload_digest"]) for r in found) == [
                       ("1", "response", "", 5, digest("other")),
                       *[("1", "revisit", "2", 4, digest("same"))] * 3,
                       ("2", "response", "", 4, digest("same"))]
