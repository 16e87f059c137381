import random
from collections import Counter
from itertools import combinations

import pytest
from conftest import physical_plan

from clickweir.operators import baskets

SCHEMA = "basket long, item string, items int, freq int"


def subsets(rows):
    held = {}
    for b, i, *_ in rows:
        if b is not None and i is not None:
            held.setdefault(b, set()).add(i)
    return Counter(c for items in held.values() for k in range(1, len(items) + 1)
                   for c in combinations(sorted(items), k))


@pytest.fixture(scope="module")
def rows():
    """One item in nearly all baskets, a basket with a third of all rows, repeats and nulls."""
    rng = random.Random(8)
    found = [(b, rng.choice("abcdefgh"), 1, 1) for b in range(150) for _ in range(rng.randrange(7))]
    found += [(b, "hot", 1, 1) for b in range(140)] * 2
    found += [(7, f"only here {i}", 1, 1) for i in range(400)]
    return found + [(None, "a", 1, 1), (3, None, None, None)]


@pytest.mark.parametrize("least, parts", [(1000, 2), (40, 1), (3, 7), (2, None)])
def test_sets_equal_brute_force(spark, rows, least, parts):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = baskets.frequent_sets(frame, "basket", "item", least, parts).collect()
    common = [r for r in rows if not (r[1] or "").startswith("only here")]
    expected = {c: n for c, n in subsets(common).items() if n >= least}
    assert {tuple(r["items"]): r["n_baskets"] for r in found} == expected
    assert len(found) == len(expected)


def test_rules_equal_brute_force(spark, rows):
    found = baskets.rules_between(spark.createDataFrame(rows, SCHEMA), "basket", "item", 5, 0.5)
    counts = subsets([r for r in rows if not (r[1] or "").startswith("only here")])
    expected = {}
    for items, n in counts.items():
        for x in items:
            rest = tuple(i for i in items if i != x)
            if rest and n >= 5 and n / counts[rest] >= 0.5:
                expected[rest, x] = n / counts[rest]
    assert {(tuple(r["antecedent"]), r["consequent"]): r["confidence"]
            for r in found.collect()} == pytest.approx(expected)


def test_rare_items_never_reach_a_basket(spark, rows):
    gathered = baskets.baskets_of(spark.createDataFrame(rows, SCHEMA), "basket", "item", 2)
    assert max(len(r["items"]) for r in gathered.collect()) <= 9


def test_nothing_to_grow(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert baskets.frequent_sets(empty, "basket", "item", 1).collect() == []
    assert baskets.rules_between(empty, "basket", "item", 1, 0.1).columns == [
        "antecedent", "consequent", "confidence"]


def test_sets_are_counted_by_shuffles_and_stored_by_level(spark, rows):
    """No prefix trees in a task, no list of items in the driver."""
    frame = spark.createDataFrame(rows, SCHEMA)
    plan = physical_plan(baskets.frequent_sets(frame, "basket", "item", 3))
    assert "ExistingRDD" not in plan and "FileScan parquet" in plan


def test_equal_baskets_are_counted_at_once(spark):
    rows = [(b, i, 1, 1) for b in range(300) for i in ("abc" if b % 3 else "abd")]
    found = baskets.frequent_sets(spark.createDataFrame(rows, SCHEMA), "basket", "item", 100)
    assert {"".join(r["items"]): r["n_baskets"] for r in found.collect()} == {
        "a": 300, "b": 300, "c": 200, "d": 100, "ab": 300, "ac": 200, "ad": 100, "bc": 200,
        "bd": 100, "abc": 200, "abd": 100}


def test_rules_are_joined_from_stored_sets(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    plan = physical_plan(baskets.rules_between(frame, "basket", "item", 5, 0.5))
    assert "ExistingRDD" not in plan and "FileScan parquet" in plan


def test_tasks_are_dealt_by_rows_and_settings_restored(spark, tmp_path, monkeypatch):
    """Files and shuffles are cut by counted rows, whatever the session's settings are."""
    rng = random.Random(4)
    spark.createDataFrame(
        [(b, f"i{i}", 1, 1) for b in range(800) for i in rng.sample(range(60), 5)], SCHEMA,
    ).repartition(4).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(baskets, "TASK_ROWS", 200, raising=False)
    monkeypatch.setattr(baskets, "TASK_BYTES", "1k", raising=False)
    names = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(name) for name in names]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sets = baskets.frequent_sets(rows, "basket", "item", 3)
        rules = baskets.rules_between(rows, "basket", "item", 3, 0.01)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [spark.conf.get(name) for name in names] == before
    # 8 000 candidate pairs in some 40 tasks, each with sets of its own.
    assert len(sets.where("size(items) = 2").inputFiles()) > 20
    assert rules.count() == sum(r["k"] for r in sets.where("size(items) > 1").selectExpr(
        "size(items) AS k").collect())
