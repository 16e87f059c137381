import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from helpers import compare

from clickweir.llm import collocations
from clickweir.llm.collocations import DoubleArray

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def brute_force(rows, least, top=2000, longest=5):
    """Rows of (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    out = []
    for lang, found in counts.items():
        frequent = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in frequent.items():
            if any(a <= b for q, b in frequent.items() if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, _, k = min((1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k, k)
                              for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, totals[lang], -score) for
                i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def check(spark, rows, least, top=2000):
    docs = spark.createDataFrame(
        [(i, lang, text, 1) for i, (lang, text) in enumerate(rows)],
        "id long, lang string, text string, rank int")
    found = collocations.collocations(docs, min_count=least, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute_force(rows, least, top)
    assert sorted(map(tuple, found.collect())) == expected
    return expected


def prose(rng, words, size):
    out = []
    for _ in range(size):
        out.append(rng.choice(["", "", "", "A ", "a b ", "New York ", "c d e f "]))
        out.append(f"w{min(rng.randrange(words), rng.randrange(words))}")
        out.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", ";", "?! "]))
    return "".join(out)


def test_query_equals_oracle(spark):
    compare(spark, "op12_collocations", SF_DIR)


def test_whole_documents_at_a_low_count(spark):
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(
        f"{SF_DIR}/documents.parquet").limit(40).collect()]
    assert len(check(spark, rows, 6)) > 50


@pytest.mark.parametrize("shard, block, walk, page", [
    (1_000_000, 1 << 26, 4_000_000, 8192), (40, 300, 500, 16)])
def test_shards_blocks_and_small_steps_give_the_same(
        spark, monkeypatch, shard, block, walk, page):
    monkeypatch.setattr(collocations, "PAGE", page)
    monkeypatch.setattr(collocations, "TALLY_KEYS", walk)
    monkeypatch.setattr(collocations, "SHARD_PHRASES", shard)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocations, "WALK_NUMBERS", walk)
    monkeypatch.setattr(collocations, "ROW_NUMBERS", 16)
    rng = random.Random(2)
    rows = [(rng.choice(["en", "de", None, "und"]), prose(rng, 30, 60)) for _ in range(60)]
    assert len(check(spark, rows, 4)) > 60
    check(spark, rows, 4, top=7)


def test_nulls_blanks_repeats_and_long_texts(spark):
    rows = [("en", None), (None, ""), ("en", " ., \n"), ("fr", "one"), (None, "É é É é É é")]
    rows += [("en", "to be or not to be: that is the question")] * 9
    rows += [("de", "x y " * 30_000), ("es", "z" * 100_000 + " q " + "z" * 100_000)]
    rows += [("en", "a\x01b c\x01d " * 6), ("en", "THE the The " * 8)]
    check(spark, rows, 5)


def test_empty_table(spark):
    assert check(spark, [], 2) == []


def test_scores_past_64_bits(spark):
    schema = "id long, lang string, phrase string, path array<int>, a long"
    big = 9 * 10 ** 15
    phrases = spark.createDataFrame([
        (1, "en", "a", [1], big), (2, "en", "b", [2], big + 1), (3, "en", "a b", [1, 2], big - 7),
    ], schema)
    totals = spark.createDataFrame([("en", 10 ** 17 + 1)], "lang string, n long")
    row = collocations.scored(phrases, totals).first()
    assert row["score"] == 1000 * (big - 7) * (10 ** 17 + 1) // (big * (big + 1))


def test_the_double_array_accepts_what_it_holds():
    rng = np.random.default_rng(4)
    paths = {tuple(rng.zipf(1.3, rng.integers(1, 6)).clip(1, 500).tolist()) for _ in range(4000)}
    paths = [np.array(p, dtype=np.int32) for p in paths]
    trie = DoubleArray(paths, np.arange(len(paths)))
    text = rng.zipf(1.3, 20_000).clip(0, 600).astype(np.int32)
    text[rng.integers(0, len(text), 2000)] = 0
    known, found = {tuple(p): k for k, p in enumerate(map(np.ndarray.tolist, paths))}, set()
    for size, (at, states) in enumerate(trie.walk(text), 1):
        for i, name in zip(at.tolist(), trie.name[states].tolist()):
            if name >= 0:
                found.add((i, size))
                assert known[tuple(text[i:i + size].tolist())] == name
    assert found == {(i, n) for i in range(len(text)) for n in range(1, 6)
                     if i + n <= len(text) and tuple(text[i:i + n].tolist()) in known}
