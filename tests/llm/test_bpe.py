import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from conftest import SF_DIR
from tokenizers import Tokenizer

from clickweir.llm import bpe
from clickweir.llm.queries import QUERIES, TOKENIZER

SCHEMA = "doc_id long, text string, ids string, decoded int"


@pytest.fixture(scope="module")
def model():
    return bpe.load_model(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"]
             for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op3_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = expected(library, texts[r["doc_id"]])
        packed = struct.pack(f"<{len(ids)}I", *ids)
        text = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_odd_and_random_texts(model, library):
    rng = random.Random(7)
    texts = ["<|endoftext|>x <|startoftext|><|endoftext|> y", "'s don't WE'LL ΣΑΣ İx ﬁ ①½ 日本語",
             "aaaa aaaaaaa bbbbbb " * 3, "<|endoftext", "x" * 5000, "\x1c é ​ 👍🏽", None, ""]
    texts += ["".join(rng.choice("aàbBeé thing's THE 09.,!<|>\n\tΣß") for _ in range(200))
              for _ in range(200)]
    for text, ids in zip(texts, bpe._Encoder(model).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == expected(library, text)


def test_forgetting_words_changes_nothing(model, monkeypatch):
    texts = [f"some words {i} and thatword{i % 5}" for i in range(40)]
    whole = bpe._Encoder(model).encode(texts)
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 10)
    small = bpe._Encoder(model)
    assert [small.encode([t])[0] for t in texts] == whole


def test_nulls_repeats_clashes_and_empty(spark, model, library):
    rows = [(1, None, "a", 1), (2, "", "b", 2), (3, "Same text", "c", 3), (4, "Same text", "d", 4),
            (None, "word " * 50_000, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    encoded = bpe.encode(frame, model)
    assert encoded.columns == ["doc_id", "text", "decoded", "ids"]
    found = {r["doc_id"]: r for r in bpe.decode(encoded, model).collect()}
    assert bytes(found[1]["ids"]) == bytes(found[2]["ids"]) == b"" and found[1]["decoded"] == ""
    assert found[3]["ids"] == found[4]["ids"]
    assert found[None]["decoded"] == library.decode(expected(library, "word " * 50_000))
    assert bpe.encode(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_texts_are_encoded_a_million_characters_at_a_time():
    import pyarrow as pa

    from clickweir.llm import bpe

    parts = list(bpe._sliced(pa.array(["x" * 1000] * 3000)))
    assert max(sum(map(len, part)) for part in parts) <= 1_001_000
    assert sum(map(len, parts)) == 3000


def test_the_round_trip_is_one_pass_in_small_batches(spark, model, monkeypatch):
    rows = [(i, f"Word{i} and more" if i % 7 else None, "a", 1) for i in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(2)
    once = bpe.round_trip(frame, model)
    assert once._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    twice = bpe.decode(bpe.encode(frame, model, keep_text=False), model)
    assert once.columns == twice.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_a_batch_leaves_in_parts(monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", 100)
    batch = pa.RecordBatch.from_pydict({"n": list(range(50)), "text": ["x" * 30] * 48 + [None, ""]})
    parts = list(bpe._cut(batch, 1))
    assert [n for part, _ in parts for n in part.column(0).to_pylist()] == list(range(50))
    assert all(part.column(1).to_pylist() == values for part, values in parts)
    assert max(part.num_rows for part, _ in parts) <= 5
