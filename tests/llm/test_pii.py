import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SF_DIR

from clickweir.llm import pii
from clickweir.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, spans int"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_force(text):
    def passes(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in value.split(".")),
                "card": 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15}[kind]

    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "")
            if passes(k, m[0])]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_base_spans_of_random_texts():
    rng = random.Random(4)
    parts = ["@", "a.b", "x", "_", "1", "23", "255", "256", ".", " ", "-", "+", "(", "c@d.e", "%",
             "4111111111111111", "é", "\n", ")"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(40))
        assert pii.base_spans(text) == brute_force(text), text


def test_query_keeps_base_spans_and_adds_secrets(spark):
    texts = {r["doc_id"]: r["text"]
             for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op5_pii"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_force(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        assert r["spans"].startswith(listed(base))
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [
            sum(s[0] == k for s in base) for k in pii.BASE_KINDS]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        token = "".join(rng.choice("0123456789abcdef") for _ in range(24))
        rows.append((3 * i, f'my password={token} and key: "{token[::-1]}" end', 0))
        rows.append((3 * i + 1, f"see version {rng.randrange(10 ** 7, 10 ** 8)} of it", 0))
        rows.append((3 * i + 2, "plain words: nothing of interest", 0))
    return spark.createDataFrame(rows, SCHEMA)


def test_classifier_tells_secrets_from_harmless_numbers(spark, corpus):
    weights = pii.fit(corpus)
    held_out = [(1, "token = 0123456789abcdef01234567 x", None), (2, "in version 12345678 x", None),
                (3, None, None), (4, "", None), (5, "mail a@b.co " + "w " * 100_000, None),
                (5, "mail a@b.co " + "w " * 100_000, None)]
    rows = pii.find(spark.createDataFrame(held_out, SCHEMA), weights).collect()
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["spans"] == "secret:8:32"
    assert found[2]["spans"] == found[3]["spans"] == found[4]["spans"] == ""
    assert found[5]["spans"] == "email:5:11" and len(rows) == 6
    assert pii.redacted(held_out[0][1], found[1]["spans"]) == "token = [secret] x"


def test_em_finds_the_unreliable_labeler():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.4
    votes = np.stack([np.where(rng.random(20_000) < good, truth, ~truth)
                      for good in (0.95, 0.9, 0.85, 0.5)], axis=1).astype(int)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = pii.estimate(patterns, counts.astype(float))[inverse]
    assert ((p > 0.5) == truth).mean() > 0.95


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.fit(empty) is None
    assert pii.find(empty, None).count() == 0


@pytest.mark.parametrize("text, kind, start", [
    ("password=" + "aB3x" * 100, "secret", 9), ("f0" * 100, "secret", 0),
    ("ABC" + "D1" * 50, "secret", 0), ("1" * 200, "secret", 0), ("@" + "h" * 40, "handle", 0)])
def test_long_values_are_covered_whole(text, kind, start):
    found = pii.candidates(text, pii.base_spans(text))
    assert [(c.kind, c.start, c.end) for c in found] == [(kind, start, len(text))]
