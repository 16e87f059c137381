from conftest import SF_DIR
from helpers import compare

from clickweir.llm import quality

SCHEMA = "doc_id long, text string, n_words string, quality int"


def brute_repeat_words(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_query_equals_oracle(spark):
    compare(spark, "op4_quality_rules", SF_DIR)


def test_nulls_long_texts_ties_and_clashing_columns(spark):
    plain = " ".join(f"w{i} the" for i in range(40))
    long = " ".join(f"w{i % 3000} of" for i in range(9000))
    texts = {1: None, 2: "", 3: " \t\n ", 4: plain, 5: plain, 6: long, 7: "a b c a b c a b c d"}
    rows = [(i, t, "clash", 7) for i, t in texts.items()] + [(None, plain, None, None)]
    judged = quality.judge(spark.createDataFrame(rows, SCHEMA))
    assert judged.columns == ["doc_id", "text", "n_words", "quality"]
    found = {r["doc_id"]: r for r in judged.collect()}
    for i, text in texts.items():
        words = (text or "").split()
        q = found[i]["quality"]
        assert q["n_words"] == len(words)
        assert q["word_chars"] == sum(map(len, words))
        if len(words) < 1000:
            assert q["n_repeat_words"] == brute_repeat_words(words)
    assert found[6]["quality"]["n_repeat_words"] == 18000
    assert found[6]["quality"]["base_failed"]
    assert found[4]["quality"]["kept"] and found[5]["quality"]["kept"]
    assert found[None]["quality"]["kept"] and found[None]["n_words"] is None
    assert not found[1]["quality"]["kept"]
    kept = quality.keep_good(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "n_words", "quality"]
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 5]


def test_few_and_many_repeated_windows_agree(spark, monkeypatch):
    texts = [(1, "x y z x y z q x y"), (2, " ".join(f"t{i % 70}" for i in range(200)))]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    counts = []
    for limit in (0, 1000):
        monkeypatch.setattr(quality, "LOOKED_UP", limit)
        counts.append([r[0] for r in quality.judge(frame).orderBy("doc_id").select(
            "quality.n_repeat_words").collect()])
    assert counts[0] == counts[1] == [brute_repeat_words(t.split()) for _, t in texts]


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_symbols_shouting_and_lists_are_rejected(spark):
    words = [f"word{i}" for i in range(60)]
    bad = [" ".join(w + "###" for w in words), " ".join(w.upper() + "!!" for w in words),
           " | ".join(words)]
    frame = spark.createDataFrame(list(enumerate(bad)), "doc_id long, text string")
    assert [r[0] for r in quality.judge(frame).select("quality.kept").collect()] == [False] * 3
