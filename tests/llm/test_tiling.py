import random
import re
import time
import tracemalloc

import numpy as np
import pytest
from conftest import SF_DIR

from clickweir.llm import tiling
from clickweir.llm.queries import QUERIES

DOCS = "doc_id long, text string, coverage string, item_id int"
ITEMS = "item_id long, text string"


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_force(item, doc):
    """Greedy string tiling straight from its definition: (tiles, tokens under tiles)."""
    marked_item, marked_doc, count, total = set(), set(), 0, 0
    while True:
        best = (tiling.MIN_MATCH - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while (i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k]
                       and i + k not in marked_item and j + k not in marked_doc):
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < tiling.MIN_MATCH:
            return count, total
        marked_item |= set(range(i, i + k))
        marked_doc |= set(range(j, j + k))
        count, total = count + 1, total + k


def run(spark, docs, items):
    found = tiling.tiled(spark.createDataFrame([(i, t, "c", 1) for i, t in docs], DOCS),
                         spark.createDataFrame(items, ITEMS))
    return {(r["doc_id"], r["item_id"]): (r["n_tiles"], r["n_matched"]) for r in found.collect()}


@pytest.mark.parametrize("per_token", [0, 4, 1000])
def test_random_texts_equal_brute_force(spark, monkeypatch, per_token):
    monkeypatch.setattr(tiling, "SEEDS_PER_TOKEN", per_token)
    rng = random.Random(11)
    words = ["a", "b", "c"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(4, 25))))
             for i in range(6)]
    docs = [(i, ", ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))))
            for i in range(15)]
    expected = {(d, i): brute_force(tokens(x), tokens(t)) for d, t in docs for i, x in items}
    assert run(spark, docs, items) == {k: v for k, v in expected.items() if v[0]}


def test_query_equals_brute_force(spark):
    docs = {r["doc_id"]: tokens(r["text"])
            for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    items = {r["item_id"]: tokens(r["text"])
             for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    rows = {(r["doc_id"], r["item_id"]): r for r in QUERIES["op8_string_tiling"](
        spark, SF_DIR).collect()}
    n = tiling.MIN_MATCH
    for i, item in items.items():
        grams = {tuple(item[k:k + n]) for k in range(len(item) - n + 1)}
        for d, doc in docs.items():
            shared = any(tuple(doc[k:k + n]) in grams for k in range(len(doc) - n + 1))
            assert shared == ((d, i) in rows)
            if shared:
                r = rows[d, i]
                assert (r["n_tiles"], r["n_matched"]) == brute_force(item, doc)
                assert r["contaminated"] == (r["n_matched"] >= 0.5 * len(item))
    assert any(r["contaminated"] for r in rows.values())


def test_reordered_passages_blocks_nulls_and_clashes(spark, monkeypatch):
    item = "The quick brown fox jumps over. The lazy dog sleeps all day long; nobody minds it"
    other = "Nothing of this text is found anywhere in the documents of the test"
    halves = item.split(". ")
    docs = [(1, f"start {halves[1].upper()} middle -- {halves[0]} end"), (2, None), (3, ""),
            (4, "clean text with the quick brown fox only"), (None, item), (5, item), (5, item),
            (6, "filler " * 50_000 + item)]
    items = [(1, item), (2, None), (3, "too short"), (4, other)]
    frame = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], DOCS)
    queries = spark.createDataFrame(items, ITEMS)
    results = []
    for size in (tiling.BLOCK_BYTES, 40):
        monkeypatch.setattr(tiling, "BLOCK_BYTES", size)
        kept = tiling.decontaminated(frame, queries)
        assert kept.columns == frame.columns
        results.append(sorted((r["doc_id"] or 0) for r in kept.collect()))
        found = run(spark, docs, items)
        assert found[1, 1] == (2, 16) and found[6, 1] == (1, 16)
    assert results == [[2, 3, 4]] * 2


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b c d e f")]) == {}
    assert run(spark, [(1, "a b c d e f")], []) == {}


def test_both_ways_give_the_same_tiles():
    rng = random.Random(4)
    for n in range(300):
        words = rng.choice([["a"], ["a", "b"], ["a", "b", "c", "d"]])
        item = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        doc = [rng.choice(words) for _ in range(rng.randrange(5, 90))]
        if n % 3 == 0:
            doc += item[rng.randrange(len(item)):] * 2
        numbers = [np.array([ord(w) for w in t], dtype=np.uint64) * np.uint64(2 ** 57 + 3)
                   for t in (item, doc)]
        found = tiling.tiles_by_length(*numbers)
        seeds = [(p, t) for p in range(len(item) - 4) for t in range(len(doc) - 4)
                 if item[p:p + 5] == doc[t:t + 5]]
        listed = tiling.tiles(*(np.array(x) for x in zip(*seeds))) if seeds else []
        assert found == listed
        assert (len(found), sum(k for *_, k in found)) == brute_force(item, doc)


@pytest.mark.parametrize("item, doc, matched", [
    ("a " * 20_000, "a " * 20_000, 20_000),
    ("a b " * 5_000, "b a " * 20_000, 10_000),
    ("a " * 9_000 + "x " + "a " * 900, ("a " * 500 + "y ") * 30, 9_900),
])
def test_repetitive_texts_take_little_time_and_memory(item, doc, matched):
    known = tiling.prepared([1], [item])
    tracemalloc.start()
    begun = time.perf_counter()
    [(_, _, _, total)] = tiling._matches(tiling.pa.array([doc]), known)
    assert time.perf_counter() - begun < 10
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()
    assert total == matched


@pytest.mark.parametrize("kind", ["date", "smallint", "decimal(20,0)", "double", "string", "int"])
def test_types_of_ids_and_equal_names(spark, kind):
    value = "DATE'2020-01-02'" if kind == "date" else f"CAST('7' AS {kind})"
    items = spark.sql(f"SELECT {value} AS doc_id, 'a b c d e f' AS text")
    docs = spark.createDataFrame([(1, "x a b c d e f", "c", 1)], DOCS)
    found = tiling.tiled(docs, items, item_id="doc_id")
    assert found.columns[:2] == ["doc_id", "item_doc_id"]
    assert found.select("item_doc_id").collect() == items.selectExpr(
        "doc_id AS item_doc_id").collect()
