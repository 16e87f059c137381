import numpy as np
import pytest
from conftest import SF_DIR

from clickweir.llm import sharding
from clickweir.llm.queries import QUERIES, SHARDS


def brute_table(shards, slots):
    """Each shard's whole permutation first, then turns over them."""
    orders = []
    for s in shards:
        offset, skip = sharding._number(s, "offset") % slots, sharding._number(s, "skip")
        orders.append([(offset + j * (skip % (slots - 1) + 1)) % slots for j in range(slots)])
    table = [None] * slots
    turn = 0
    while None in table:
        order = orders[turn % len(shards)]
        table[next(s for s in order if table[s] is None)] = turn % len(shards)
        turn += 1
    return table


def test_table_equals_brute_force():
    for n, slots in [(1, 11), (3, 31), (7, 211)]:
        shards = [f"s{k}" for k in range(n)]
        assert sharding.lookup_table(shards, slots).tolist() == brute_table(shards, slots)


def test_even_and_little_disrupted():
    table = sharding.lookup_table(SHARDS)
    counts = np.bincount(table, minlength=len(SHARDS))
    assert counts.max() - counts.min() <= 1
    fewer = sharding.lookup_table(SHARDS[:-1])
    stayed = table != len(SHARDS) - 1
    assert (table[stayed] != fewer[stayed]).mean() < 0.15


def test_query_places_every_document(spark):
    table = sharding.lookup_table(SHARDS)
    rows = QUERIES["op7_sharding"](spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r["shard"] == SHARDS[table[r["slot"]]] for r in rows)


def test_nulls_ties_clashes_and_empty(spark, tmp_path):
    schema = "k string, slot string, shard int"
    rows = [("a", "x", 1), ("a", "y", 2), (None, "z", 3), ("", None, None), ("b" * 100_000, "", 0)]
    placed = sharding.place(spark.createDataFrame(rows, schema), "k", ["p", "q"], 101)
    assert placed.columns == ["k", "slot", "shard"]
    found = placed.collect()
    assert len(found) == 5 and {r["shard"] for r in found} <= {"p", "q"}
    assert len({r["slot"] for r in found if r["k"] == "a"}) == 1
    assert sharding.place(spark.createDataFrame([], schema), "k", ["p"]).count() == 0
    sharding.write_shards(spark.createDataFrame(rows, schema), "k", ["p", "q"], f"{tmp_path}/o")
    assert spark.read.parquet(f"{tmp_path}/o").count() == 5


def test_bad_shards():
    for shards in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards)
