import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_DIR

from clickweir.llm import minhash
from clickweir.llm.components import components
from clickweir.llm.queries import QUERIES
from clickweir.llm.scratch import Scratch

SCHEMA = "doc_id long, text string, id string, digest int"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(texts):
    """id -> (n_shingles, component_id); tests every pair."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = defaultdict(list)
    for i in sorted(sets):
        for j in {j for s in sets[i] for j in index[s]}:
            common = len(sets[i] & sets[j])
            if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            index[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in texts}


def check(spark, texts):
    rows = [(i, t, "x", 0) for i, t in texts.items()]
    found = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = brute_force(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"]
             for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op2_minhash_circulant"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_force(texts)


def test_crowds_of_near_copies_and_of_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CROWD", 4)
    rng = random.Random(3)

    def words(n):
        return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]

    base, passage = words(80), words(60)
    texts = {}
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(80)] = "changed"
        if i % 4 == 0:
            copy[rng.randrange(80)] = "again"
        texts[100 - i] = " ".join(copy)
    for i in range(200, 240):
        texts[i] = " ".join(passage + words(rng.randrange(5, 30)))
    for i in range(300, 320):
        texts[i] = texts[200] + f" tail{i % 3}"
    check(spark, texts)


def test_odd_texts_and_ties(spark):
    texts = {1: None, 2: "", 3: " \n\t", 4: "one two", 5: "One TWO", 6: "one two three",
             7: "É é", 8: "é é", 9: "a\x0bb c\x0cd e", 10: "a b c d e", 11: "x " * 60_000,
             12: "x " * 5, 13: " ".join(f"u{i}" for i in range(30_000))}
    check(spark, texts)


def test_null_and_repeated_ids_and_empty_table(spark):
    rows = [(None, "same text", "", 0), (5, "same text", "", 0), (5, "same text", "", 1),
            (None, "alone here", "", 0), (7, "same text", None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = minhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [
        (0, "alone here"), (5, "same text")]
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("blocks", [1 << 15, 8])
def test_signatures_follow_the_definition(monkeypatch, blocks):
    monkeypatch.setattr(minhash, "_BLOCK", blocks)
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    bounds = np.array([0, 1, 40, 41, 300])
    found = minhash.signatures(values, bounds, 12)
    for d in range(4):
        own = (values[bounds[d]:bounds[d + 1]] >> np.uint64(32)).astype(np.uint32)
        at = minhash._scattered(own)
        for k in range(12):
            shifted = at - np.uint32(k)
            least = minhash._permuted(shifted, np.empty_like(at), np.empty_like(at)).min()
            assert found[d, k] == least


def test_both_permutations_are_bijections():
    sample = np.random.default_rng(2).integers(0, 2 ** 32, 400_000, dtype=np.uint32)
    sample = np.unique(sample)
    assert len(np.unique(minhash._scattered(sample))) == len(sample)
    out = minhash._permuted(sample, np.empty_like(sample), np.empty_like(sample))
    assert len(np.unique(out)) == len(sample)


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    links += [(200, 201), (201, 202), (202, 200), (300, 300)]
    scratch = Scratch(spark, "components")
    found = components(spark.createDataFrame(links, "a long, b long"), scratch).collect()
    labels = {r["u"]: r["label"] for r in found}
    scratch.close()
    assert labels == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)},
                      200: 200, 201: 200, 202: 200}


def test_keep_one_leaves_one_row_of_each_component(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(5, text), (5, text), (7, text), (9, text + " end"), (None, text), (None, "a b"),
            (None, "a b"), (3, None), (3, None), (4, "other words")]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA).repartition(3)
    left = minhash.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(
        [(5, text), (None, "a b"), (3, None), (3, None), (4, "other words")], key=str)
