import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from clickweir.llm import lm
from clickweir.llm.queries import QUERIES


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def write(spark, tmp_path, rows, files=3):
    path = f"{tmp_path}/docs"
    spark.createDataFrame(rows, "doc_id long, text string, score string, trains int").repartition(
        files).write.parquet(path)
    return spark.read.parquet(path)


def brute_force(texts, trains, weights):
    """id -> (n_tokens, n_known, train tokens, base score, score)."""
    words, pairs = Counter(), Counter()
    for i, text in texts.items():
        if trains(i):
            t = tokens(text)
            words.update(t)
            pairs.update(zip([None, *t], t))
    n, v = words.total(), len(words)
    found = {}
    for i, text in texts.items():
        t = tokens(text)
        base = sum(log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        score = 0.0
        for c, w in zip([None, *t], t):
            mix = weights[lm.bucket_of(np.array([words[c]]))[0]]
            score += log10(mix[0] * pairs[c, w] / max(words[c], 1) + mix[1] * words[w] / max(n, 1)
                           + mix[2] / (v + 1))
        found[i] = (len(t), sum(words[w] > 0 for w in t), n, base, score)
    return found


@pytest.fixture
def seen_weights(monkeypatch):
    """The weights that the operator learns."""
    kept = {}
    learned = lm.learned

    def spy(*args):
        kept["weights"] = learned(*args)
        return kept["weights"]

    monkeypatch.setattr(lm, "learned", spy)
    return kept


def same(rows, expected):
    assert len(rows) == len(expected)
    for r in rows:
        e = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == e[:3]
        assert r["base_score"] == pytest.approx(e[3], rel=1e-9)
        assert r["score"] == pytest.approx(e[4], rel=1e-9)


def test_query_equals_brute_force(spark, seen_weights):
    texts = {r["doc_id"]: r["text"]
             for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op10_deleted_interpolation"](spark, SF_DIR).collect()

    def trains(i):
        return zlib.crc32(str(i).encode()) % 5 != 1

    assert all(r["held_out"] == (not trains(r["doc_id"])) for r in rows)
    same(rows, brute_force(texts, trains, seen_weights["weights"]))
    held = [r for r in rows if r["held_out"]]
    # The mixture predicts unseen text better than its unigram part.
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("block, part", [(200, 300), (10 ** 7, 10 ** 7)])
def test_blocks_and_parts_change_nothing(spark, tmp_path, monkeypatch, seen_weights, block, part):
    monkeypatch.setattr(lm, "PART_BYTES", part)
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    rng = np.random.default_rng(6)
    texts = {i: " ".join(f"w{k}" for k in rng.zipf(1.5, rng.integers(1, 60)) % 50)
             for i in range(60)}
    texts |= {100: None, 101: "", 102: " \n", 103: "the " * 20_000, 104: "The THE the É é"}
    docs = write(spark, tmp_path, [(i, t, "s", 1) for i, t in texts.items()])
    rows = lm.score(docs, F.col("doc_id") % 3 != 0).collect()
    same(rows, brute_force(texts, lambda i: i % 3 != 0, seen_weights["weights"]))


def test_em_recovers_the_mixture():
    rng = np.random.default_rng(1)
    truth, kinds, n = np.array([0.6, 0.3, 0.1]), 999, 100_000
    # Bucket 3: a token drawn from the bigram part has p2 = 1/2, from the unigram part p1 = 1/4.
    part = rng.choice(3, n, p=truth)
    two = np.where(part == 0, 3, 0)
    one = np.where(part == 1, 5, 0)
    cells = (3 * lm._LEVELS + two) * lm._LEVELS + one
    values, times = np.unique(cells, return_counts=True)
    weights = lm.learned(values, times.astype(float), kinds)
    assert np.abs(weights[3] - truth).max() < 0.01
    assert np.allclose(weights.sum(1), 1)


def test_nothing_to_learn_from_and_repeats(spark, tmp_path):
    docs = write(spark, tmp_path, [(1, "a b", "s", 1), (1, "a b", "s", 2), (None, "a", None, None)])
    rows = lm.score(docs, F.lit(False)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows} == {
        (1, 3, 0, 0), (None, 2, 0, 0)}
    assert all(r["score"] == 0.0 for r in rows) and len(rows) == 3


def test_empty_table(spark, tmp_path):
    assert lm.score(write(spark, tmp_path, [], 1), F.lit(True)).count() == 0


def test_packing():
    for kind in (np.uint32, np.uint64):
        values = np.random.default_rng(2).integers(0, np.iinfo(kind).max, 100, dtype=kind)
        assert (lm.unpacked(lm.packed(values), kind) == values).all()
    assert len(lm.unpacked(lm.packed(np.zeros(0, np.uint32)), np.uint32)) == 0


@pytest.mark.parametrize("top", [0, 255, 256, 2 ** 32 - 1, 2 ** 32, 2 ** 53])
def test_counts_of_any_size_are_packed(top):
    values = np.array([0, 1, top], dtype=np.uint64)
    assert (lm.unpacked_counts(lm.packed_counts(values)) == values).all()
    assert len(lm.unpacked_counts(lm.packed_counts(values[:0]))) == 0


def test_sums_beyond_32_bits(spark):
    """Two blocks with 3e9 of one word each: the part answers with the whole sum."""
    key = lm.packed(np.array([7], dtype=np.uint64))
    asked = spark.createDataFrame(
        [(0, b, key, lm.packed_counts(np.array([3 * 10 ** 9], dtype=np.uint64))) for b in (1, 2)],
        "part int, block long, keys binary, counts binary")
    rows = lm.answers(asked).collect()
    assert [int(lm.unpacked_counts(bytes(r["counts"]))[0]) for r in rows] == [6 * 10 ** 9] * 2
    assert sum(r["total"] for r in rows) == 6 * 10 ** 9
