"""Keyed tables of sorted runs: folds, repeats, crashes, ties, cost of a batch."""

import random

import pytest
from conftest import physical_plan
from pyspark.sql import functions as F

from clickweir import manifests, runs

SCHEMA = "kind string, k int, at int, v string"
KEYS, ORDER = ["kind", "k"], ["at"]


def put(spark, path, batch_id, rows, fan_in=2):
    stored = runs.put_batch(spark.createDataFrame(rows, SCHEMA), path, batch_id, KEYS, ORDER,
                            ["kind"])
    runs.fold(spark, path, fan_in)
    return stored


def current(spark, path, where=None):
    return {(r.kind, r.k): (r.at, r.v) for r in runs.read_current(spark, path, where).collect()}


def test_equals_a_plain_map_over_many_batches(spark, tmp_path):
    path, rng, expected = f"{tmp_path}/t", random.Random(3), {}
    assert runs.read_current(spark, path) is None and runs.runs_of(spark, path) == []
    for batch_id in range(0, 18, 2):  # numbers may have gaps
        rows = [(rng.choice("ab"), rng.randrange(6), rng.randrange(20), f"{batch_id}-{i:02d}")
                for i in range(8)]
        put(spark, path, batch_id, rows)
        for kind, k, at, v in rows:
            old = expected.get((kind, k))
            later = old is None or at > old[0] or (
                at == old[0] and (old[1].split("-")[0] != str(batch_id) or v > old[1]))
            if later:
                expected[kind, k] = (at, v)
    assert current(spark, path) == expected
    assert current(spark, path, F.col("kind") == "a") == {
        key: value for key, value in expected.items() if key[0] == "a"}
    # Nine batches, folded by two: 1 + 8.
    assert runs.runs_of(spark, path) == [(3, 14), (0, 16)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert put(spark, path, 0, [("a", 1, 1, "x"), ("a", 1, 1, "y"), ("a", 2, None, "z")])
    assert not put(spark, path, 0, [("a", 1, 9, "other")])
    assert put(spark, path, 1, [("a", 1, 0, "older"), ("a", 2, 0, "dated")])
    assert not put(spark, path, 1, [])
    assert current(spark, path) == {("a", 1): (1, "y"), ("a", 2): (0, "dated")}
    with pytest.raises(ValueError):
        runs.put_batch(spark.createDataFrame([], SCHEMA), path, 2, ["k"], ORDER)


def test_null_keys_and_empty_batches(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark, path, 0, [])
    assert current(spark, path) == {}
    put(spark, path, 1, [("a", None, 1, "x"), ("b", None, 1, "e")])
    put(spark, path, 2, [("a", None, 2, "y")])
    assert current(spark, path) == {("a", None): (2, "y"), ("b", None): (1, "e")}
    for kind in (None, ""):  # a folder's value
        with pytest.raises(Exception, match="kind is empty"):
            put(spark, path, 3, [(kind, 1, 1, "x")])
    assert put(spark, path, 3, [("a", 1, 1, "x")])


def test_a_crash_before_the_manifest_leaves_the_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    put(spark, path, 0, [("a", 1, 1, "x")])
    with monkeypatch.context() as patch:
        def crash(*_):
            raise OSError("lost")
        patch.setattr(manifests, "commit", crash)
        with pytest.raises(OSError):
            put(spark, path, 1, [("a", 1, 2, "y")])
    assert current(spark, path) == {("a", 1): (1, "x")}
    assert len(list((tmp_path / "t").glob("run=*"))) == 2
    put(spark, path, 1, [("a", 1, 2, "y")])
    assert current(spark, path) == {("a", 1): (2, "y")}
    # Both of batch 0 and 1, their fold; the orphan is gone.
    assert len(list((tmp_path / "t").glob("run=*"))) == 3


def test_files_and_cost_of_a_batch_do_not_grow_with_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    big = spark.range(200_000).selectExpr("'a' AS kind", "CAST(id AS INT) AS k", "0 AS at",
                                          "uuid() AS v")
    runs.put_batch(big, path, 0, KEYS, ORDER, ["kind"])
    table = sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet"))
    for batch_id in range(1, 8):
        known = set((tmp_path / "t").rglob("*.parquet"))
        put(spark, path, batch_id, [("a", batch_id, 1, "n")], fan_in=8)
        added = set((tmp_path / "t").rglob("*.parquet")) - known
        if batch_id < 7:
            assert sum(f.stat().st_size for f in added) < table / 1000
    assert runs.runs_of(spark, path) == [(1, 7)]
    only = runs.read_current(spark, path, (F.col("kind") == "a") & (F.col("k") == 5))
    plan = physical_plan(only)
    assert "Exchange" not in plan and "EqualTo(k,5)" in plan
    assert [r.v for r in only.collect()] == ["n"]
    assert runs.read_current(spark, path).count() == 200_000
