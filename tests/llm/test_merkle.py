import random
import zlib
from hashlib import sha256

import pytest
from conftest import SF_DIR
from helpers import compare

from clickweir.llm import merkle
from clickweir.llm.oracle import ORACLE_SQL
from clickweir.llm.queries import QUERIES, op13_merkle_manifest
from clickweir.llm.scratch import Scratch

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def siblings_of(levels, at):
    for level in levels[:-1]:
        run = at // 2 * 2
        yield [(i < at, level[i]) for i in range(run, min(run + 2, len(level))) if i != at]
        at //= 2


def brute_force(rows):
    """The rows of the query, sorted as text."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([leaf(r) for r in groups[g]]) for g in langs}
    top = levels_of([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for at, row in enumerate(groups[g]):
            steps = [*siblings_of(trees[g], at), *siblings_of(top, k)]
            claimed = row
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                claimed = (*row[:3], row[3] + 1, row[4])
            digest = leaf(claimed)
            for step in steps:
                digest = h(*[d for left, d in step if left], digest,
                           *[d for left, d in step if not left])
            proof = h(*[d for step in steps for _, d in step])
            out.append((row[0], leaf(row), trees[g][-1][0], top[-1][0], proof, digest,
                        digest == top[-1][0]))
    return sorted(out, key=str)


def answer(frame):
    return sorted(map(tuple, frame.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()),
        key=str)


@pytest.fixture
def query(spark, tmp_path):
    def run(rows, schema=SCHEMA):
        frame = spark.createDataFrame(rows, schema)
        frame.write.parquet(f"{tmp_path}/documents.parquet")
        return op13_merkle_manifest(spark, str(tmp_path))
    return run


def test_query_equals_oracle(spark):
    assert "op13_merkle_manifest" in ORACLE_SQL
    compare(spark, "op13_merkle_manifest", SF_DIR)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select(
        "doc_id", "source", "lang", "n_chars", "text").collect()]
    assert answer(QUERIES["op13_merkle_manifest"](spark, SF_DIR)) == brute_force(rows)


@pytest.mark.parametrize("n", [1, 4, 21])
def test_small_buckets_of_levels(query, monkeypatch, n):
    monkeypatch.setattr(merkle, "SPAN", 2)
    rng = random.Random(n)
    rows = [(rng.randrange(10 ** 9), "s", lang, k, "t" * k)
            for lang, size in (("en", n), ("de", 5), ("fr", 1)) for k in range(size)]
    assert answer(query(rows)) == brute_force(rows)


def test_nulls_repeats_odd_groups_and_long_texts(query, monkeypatch):
    monkeypatch.setattr(merkle, "SPAN", 3)
    rows = [(None, None, None, None, None), (None, "s", None, 3, "abc"), (7, "s", "-", 1, "é"),
            (7, "s", "-", 1, "é"), (7, "s", "-", 2, "zz"), (8, "s", "", 5, ""),
            (9, "s", "ÿ", 5, "x" * 300_000), (10, "s", "z", None, "a\nb")]
    rows += [(11, "same", "en", 4, "copy")] * 40
    rows += [(k, None, "en", k, None) for k in range(12, 40)]
    assert answer(query(rows)) == brute_force(rows)


def test_many_groups(query, monkeypatch):
    monkeypatch.setattr(merkle, "SPAN", 2)
    rows = [(k, "s", f"g{k % 37}", k, str(k)) for k in range(120)]
    assert answer(query(rows)) == brute_force(rows)


def test_empty_table(query):
    assert query([]).count() == 0


def test_nodes_cover_their_children_and_extra_columns_clash(spark):
    docs = spark.createDataFrame(
        [(k, "x", k, "tree", "path") for k in range(13)],
        "doc_id long, tree string, lo long, digest string, siblings string")
    scratch = Scratch(spark, "merkle-test")
    manifest = merkle.Manifest(docs, "doc_id", "tree", ["doc_id", "digest"], scratch)
    nodes = [(r["level"], r["lo"], r["hi"]) for r in manifest.nodes.where("tree = '=x'").collect()]
    assert sorted(nodes) == sorted(
        (level, lo, min(lo + 2 ** level, 13)) for level in range(1, 5)
        for lo in range(0, 13, 2 ** level))
    assert manifest.proofs().count() == 13
    scratch.close()
