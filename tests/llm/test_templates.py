import random
import re
from collections import defaultdict

import pytest
from conftest import SF_DIR

from clickweir.llm import templates
from clickweir.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n_lines string, lines int"


def drop(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    return templates.drop_recurring(frame, **options)


def tokens_of(line):
    return tuple("<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^ \t-\r]+", line))


def needed(n):
    return 10 if n < 5 else 3 if n < 50 else 2


def alike(a, b):
    return 100 * sum(x == y for x, y in zip(a, b)) >= 80 * len(a)


def tree(rows):
    """leaf -> {token list: documents} of all lines."""
    leaves = defaultdict(lambda: defaultdict(set))
    for i, text in rows:
        for line in (text or "").split("\n"):
            found = tokens_of(line)
            if found:
                leaves[len(found), found[:3]][found].add(i)
    return leaves


def recurring(rows):
    """Token lists that are the template of enough documents, by comparing all in a leaf."""
    out = set()
    for (n, _), lines in tree(rows).items():
        if len(set().union(*lines.values())) >= needed(n):
            out |= {a for a in lines if len(set().union(
                *(docs for b, docs in lines.items() if alike(a, b)))) >= needed(n)}
    return out


def sound_and_recall(rows, found):
    """Every dropped line has a template that recurs; the share of recurring ones dropped."""
    expected, dropped = recurring(rows), defaultdict(int)
    by_leaf = defaultdict(list)
    for a in expected:
        by_leaf[len(a), a[:3]].append(a)
    for i, text in rows:
        before, after = (text or "").split("\n"), (found[i] or "").split("\n")
        for line in set(before):
            lost = before.count(line) - after.count(line)
            words = tokens_of(line)
            if lost > 0:
                assert any(alike(a, words) for a in by_leaf[len(words), words[:3]]), line
                dropped[words] += lost
    places = defaultdict(int)
    for i, text in rows:
        for line in (text or "").split("\n"):
            places[tokens_of(line)] += 1
    # All places but possibly the first one go.
    gone = [a for a in expected if dropped[a] >= max(1, places[a] - 1) or places[a] == 1 and any(
        dropped[b] for b in by_leaf[len(a), a[:3]] if b != a and alike(a, b))]
    return len(gone) / max(1, len(expected)), len(expected)


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.1"])
def test_recall_against_a_tree_that_compares_all(spark, sf_dir):
    rows = [(r["doc_id"], r["text"])
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = {r["doc_id"]: r["text"] for r in QUERIES["op9_line_templates"](spark, sf_dir).collect()}
    share, size = sound_and_recall(rows, found)
    print(f"recall {share:.3f} of {size}")
    assert share >= 0.9 and size > 20


def test_wildcards_anywhere_after_the_leading_tokens(spark):
    words = [f"w{chr(97 + k)}" for k in range(20)]
    rows = []
    for i in range(6):
        own = list(words)
        for k in random.Random(i).sample(range(3, 20), 2):
            own[k] = f"own{'abcdef'[i]}{'xyz'[k % 3]}"
        rows.append((i, f"text of {'abcdef'[i]}\n" + " ".join(own)))
    found = {r["doc_id"]: r for r in drop(spark, rows).collect()}
    assert drop(spark, rows).columns == ["doc_id", "text", "lines", "n_lines", "n_dropped"]
    assert found[0]["text"] == rows[0][1] and found[0]["n_dropped"] == 0
    assert sum(r["n_dropped"] for r in found.values()) >= 4
    assert all(r["text"].startswith("text of") and r["n_lines"] == 2 for r in found.values())


def test_fields_with_digits_and_the_least_place(spark):
    rows = [(i, f"own {'abcd'[i]}\nSeen {i * 7} times by user{i} on host at noon") for i in range(4)]
    found = {r["doc_id"]: r["text"] for r in drop(spark, rows).collect()}
    assert found == {0: rows[0][1], 1: "own b", 2: "own c", 3: "own d"}


def test_documents_needed_by_length(spark):
    long, middle, short = " ".join(["long"] * 50), "five tokens are in this", "two words"
    rows = [(1, long), (2, long), (3, middle), (4, middle)]
    rows += [(k, short) for k in range(10, 19)]
    assert {r["doc_id"] for r in drop(spark, rows).collect() if r["n_dropped"]} == {2}
    rows += [(5, middle), (19, short)]
    assert {r["doc_id"] for r in drop(spark, rows).collect() if r["n_dropped"]} == {
        2, 4, 5, *range(11, 20)}


def test_copies_of_a_text_count_as_documents(spark):
    rows = [(i, "a line that is the same\nin whole copies only of it") for i in range(5)]
    assert sorted(r["n_dropped"] for r in drop(spark, rows).collect()) == [0, 2, 2, 2, 2]
    # Rows of one id are one document.
    assert {r["n_dropped"] for r in drop(spark, [(1, rows[0][1])] * 5).collect()} == {0}


def test_hot_leaf_of_dissimilar_lines(spark, monkeypatch):
    monkeypatch.setattr(templates, "DEAL", 4)
    rng = random.Random(4)
    rows = [(k, "one leaf for " + " ".join(rng.choice("abcdefgh") * 2 for _ in range(9)))
            for k in range(150)]
    found = {r["doc_id"]: r["text"] for r in drop(spark, rows).collect()}
    sound_and_recall(rows, found)
    rows = [(k, f"one leaf for a {'bcdefghi'[k % 8]} passage that is in all of them") for k in
            range(80)]
    assert sum(r["n_dropped"] for r in drop(spark, rows).collect()) == 79


def test_nulls_blanks_repeats_and_long_texts(spark):
    rng = random.Random(1)
    long = "\n".join(" ".join(rng.choice("abcdefghij") * 3 for _ in range(20)) for _ in range(3000))
    word = "x" * 300_000
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "some line here with five\nmore"),
            (4, "some line here with five\nother"), (4, "some line here with five\nother"),
            (5, "some line here with five\nlast"), (6, long), (7, word + "\n" + word)]
    found = [(r["doc_id"], r["text"], r["n_dropped"]) for r in drop(spark, rows).collect()]
    assert sorted(f for f in found if f[0] in (2, 3, 4, 5)) == [
        (2, "", 0), (3, "\n\n", 0), (4, "other", 1), (4, "other", 1), (5, "last", 1)]
    assert (1, None, 0) in found and (None, "some line here with five\nmore", 0) in found
    assert (6, long, 0) in found and (7, word + "\n" + word, 0) in found


def test_empty_table(spark):
    assert drop(spark, []).count() == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    rows = [(i, f"the same line of text\nown {i} x{i} y") for i in range(6)]
    broadcast = sorted(map(tuple, drop(spark, rows).collect()))
    monkeypatch.setattr(templates, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, drop(spark, rows).collect())) == broadcast
