import struct

import duckdb
import public_tokenizers
import test_minhash
import test_tiling
from conftest import SF_DIR
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from clickweir.llm import templates
from clickweir.llm.oracle import ORACLE_SQL


def brute_force(spark, sf_dir):
    """doc_id -> token ids. What the lines' templates leave has its own tests."""
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE TABLE {name} AS FROM read_parquet('{sf_dir}/{name}.parquet')")
    good = [r[0] for r in db.execute(
        f"SELECT doc_id FROM ({ORACLE_SQL['op4_quality_rules']}) WHERE kept").fetchall()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("doc_id").isin(good))
    texts = {r["doc_id"]: r["text"] for r in templates.drop_recurring(docs).collect()
             if r["n_dropped"] == 0 or r["text"].strip(" \t\n\r\x0b\x0c")}
    groups = test_minhash.brute_force(texts)
    texts = {i: t for i, t in texts.items() if groups[i][1] == i}
    items = [test_tiling.tokens(t) for (t,) in db.execute("SELECT text FROM benchmark").fetchall()]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {}
    for i, text in texts.items():
        doc = test_tiling.tokens(text)
        grams = {tuple(doc[k:k + 5]) for k in range(len(doc) - 4)}
        if not any(grams & {tuple(x[k:k + 5]) for k in range(len(x) - 4)}
                   and test_tiling.brute_force(x, doc)[1] >= 0.5 * len(x) for x in items):
            found[i] = library.encode(text, add_special_tokens=False).ids
    return found


def test_run_equals_brute_force(spark):
    expected = brute_force(spark, SF_DIR)
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in rows} == {
        i: struct.pack(f"<{len(ids)}I", *ids) for i, ids in expected.items()}
    assert all(r["n_tokens"] == len(expected[r["doc_id"]]) for r in rows)
    assert len(rows) == len(expected)


def test_stages_bear_nulls_odd_texts_and_extra_columns(spark, tmp_path):
    clean = " ".join(f"the word{i} of" for i in range(60))
    rows = [(1, None), (2, ""), (3, clean), (3, clean), (4, clean), (None, clean + " end"),
            (5, "word " * 60_000), (6, "x" * 200_000)]
    docs = spark.createDataFrame(
        [(i, t, None, "s", 0, "clash", 1, "x") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars int, quality string, "
        "lines long, ids string")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    # A row without an id belongs to exact copies only; repeated rows leave one.
    assert sorted((r["doc_id"] for r in docs.collect()), key=str) == [3, None]


def test_stages_bear_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0


def test_the_pipeline_is_registered():
    names = list(contract.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
