import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_DIR

from clickweir.llm import jaccard
from clickweir.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n int, digest string"


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute_force(texts):
    """id -> (n_shingles, component_id); tests every pair that shares anything."""
    sets = {i: grams(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = defaultdict(list)
    for i in sorted(sets):
        for j in {j for s in sets[i] for j in index[s]}:
            common = len(sets[i] & sets[j])
            if 100 * common >= 90 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            index[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in texts}


def check(spark, texts):
    rows = [(i, t, 1, "x") for i, t in texts.items()]
    found = jaccard.similarity_classes(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    expected = brute_force(texts)
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == expected
    return expected


def edited(rng, words, times, vocabulary=5000):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"n{rng.randrange(vocabulary)}"
    return words


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"]
             for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op11_vertical_jaccard"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_force(texts)


@pytest.mark.parametrize("crowd, deal", [(32, 512), (3, 4)])
def test_crowds_chains_and_shared_passages(spark, monkeypatch, crowd, deal):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    monkeypatch.setattr(jaccard, "DEAL", deal)
    rng = random.Random(5)
    base = [f"b{rng.randrange(4000)}" for _ in range(200)]
    texts, key = {}, 0
    for _ in range(25):  # near copies, at and around the threshold
        texts[key] = " ".join(edited(rng, base, rng.randrange(0, 5)))
        key += 1
    chain = base[::-1]
    for _ in range(12):  # a chain of small steps
        chain = edited(rng, chain, 2)
        texts[key] = " ".join(chain)
        key += 1
    passage = [f"p{i}" for i in range(30)]
    for k in range(40):  # most of the text is shared, yet not enough
        texts[key] = " ".join(passage + [f"own{k}-{j}" for j in range(rng.randrange(1, 7))])
        key += 1
    for k in range(20):  # short texts
        texts[key] = " ".join(f"s{rng.randrange(3)}" for _ in range(rng.randrange(0, 12)))
        key += 1
    found = check(spark, texts)
    assert len({c for _, c in found.values()}) < len(texts)


def test_the_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(21)]  # 19 grams
    texts = {1: " ".join(words), 2: " ".join(words[:-1]), 3: " ".join(words[:-2]),
             4: " ".join(words[:-3]), 5: " ".join([*words, "x"]), 6: " ".join(["y", *words, "x"])}
    check(spark, texts)
    check(spark, {i: t for i, t in texts.items() if i in (1, 4)})


def test_nulls_repeats_blanks_and_long_texts(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"),
            (9, "a b c d"), (9, "a b c d"), (9, "e f g h"), (8, "A B\nC D"), (None, "a b c d"),
            (None, None), (None, "nobody else has this"), (10, long), (11, long + " end"),
            (12, "x" * 200_000), (13, "rep " * 50_000)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    found = sorted((tuple(r) for r in jaccard.similarity_classes(frame).collect()), key=str)
    assert found == sorted([
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (9, 2, 8), (9, 2, 8),
        (9, 2, 9), (8, 2, 8), (None, 2, 8), (None, 0, None), (None, 2, None),
        (10, 59_998, 10), (11, 59_999, 10), (12, 1, 12), (13, 1, 13)], key=str)


def test_repeated_rows_of_near_copies(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words), 1, "x")] * 30 + [(2, " ".join([*words, "end"]), 1, "x")] * 30
    found = jaccard.similarity_classes(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert {tuple(r) for r in found.collect()} == {(1, 58, 1), (2, 59, 1)}
    assert found.count() == 60


def test_text_ids_and_shuffled_lists_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_BYTES", -1)
    rng = random.Random(8)
    base = [f"b{k}" for k in range(80)]
    rows = [(f"id{k:03d}", " ".join(edited(rng, base, 1))) for k in range(12)]
    found = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id string, text string"))
    expected = brute_force(dict(rows))
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == expected


def test_empty_table(spark):
    assert jaccard.similarity_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_similar_sets_share_a_bucket():
    rng = np.random.default_rng(1)
    for n in (1, 5, 9, 10, 11, 40, 333):
        starts = jaccard.length_classes(4 * n, 90)
        own = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2))
        for _ in range(30):
            lost = rng.integers(0, n // 10 + 1)
            other = np.unique(np.concatenate([
                rng.permutation(own)[lost:],
                rng.integers(0, 2 ** 63, rng.integers(0, n // 10 + 1)).astype(np.uint64)]))
            common = len(np.intersect1d(own, other))
            if 100 * common >= 90 * (len(own) + len(other) - common):
                assert set(jaccard.buckets(own, starts, 90)) & set(
                    jaccard.buckets(other, starts, 90))


def test_sets_differ_in_at_least_as_many_grams_as_sketches_in_bits():
    rng = np.random.default_rng(2)
    for n in (1, 3, 40, 700, 5000):
        own = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        for lost in (0, 1, n // 10, n):
            other = np.unique(np.concatenate([
                rng.permutation(own)[lost:], rng.integers(0, 2 ** 63, lost).astype(np.uint64)]))
            bits = np.unpackbits((jaccard.sketch(own) ^ jaccard.sketch(other)).view(np.uint8)).sum()
            assert bits <= len(np.setxor1d(own, other))


def test_near_copies_below_the_threshold_make_few_pairs(spark, monkeypatch):
    """They share fragments and rare n-grams, yet their number of pairs is not tested."""
    tested, confirmed = [], jaccard._Join.confirmed

    def counted(self, pairs):
        tested.append(pairs.count())
        return confirmed(self, pairs)

    monkeypatch.setattr(jaccard._Join, "confirmed", counted)
    rng = random.Random(11)
    base = [f"b{k}" for k in range(100)]
    texts = {k: " ".join(edited(rng, base, 4, 10 ** 9)) for k in range(70)}
    texts |= {100: " ".join(base), 101: " ".join([*base, "end"])}
    found = check(spark, texts)
    assert found[101][1] == 100 and len({c for _, c in found.values()}) > 60
    assert sum(tested) < 4 * len(texts)
