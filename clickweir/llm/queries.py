"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm import (bpe, collocations, jaccard, lm, merkle, minhash, pii, quality,
                           sharding, templates, tiling, urls, warc)
from clickweir.llm.scratch import Scratch
from clickweir.workspace import materialized

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SHARDS = [f"shard-{k:03d}" for k in range(64)]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return records.select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op2_minhash_circulant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = bpe.load_model(TOKENIZER)
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.round_trip(documents, model).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            "kept"]
    return judged.select(
        "doc_id", *[F.col("quality")[c].alias(c) for c in base],
        F.array_join("quality.broken", ",").alias("broken"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.find(documents, pii.fit(documents))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    return urls.filter_urls(_table(spark, sf_dir, "pages", "page_id", "url"), outcomes).select(
        "page_id", "host", "path", "rule", "verdict", F.round("bad_low", 9).alias("bad_low"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents", "doc_id"), "doc_id", SHARDS)


def op8_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.tiled(
        _table(spark, sf_dir, "documents", "doc_id", "text"),
        _table(spark, sf_dir, "benchmark", "item_id", "text"),
    ).withColumn("contaminated", F.col("coverage") >= tiling.COVERAGE)


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return templates.drop_recurring(documents).select("doc_id", "n_lines", "n_dropped", "text")


def op10_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    return lm.score(_table(spark, sf_dir, "documents", "doc_id", "text"), ~held_out).select(
        "doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op11_vertical_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents", "text", "lang"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    documents = _table(spark, sf_dir, "documents", *fields)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = merkle.leaf_digest([
        F.when(tampered, F.col(f) + 1).otherwise(F.col(f)) if f == "n_chars" else F.col(f)
        for f in fields])
    scratch = Scratch(spark, "merkle")
    manifest = merkle.Manifest(documents, "doc_id", "lang", fields, scratch, {"claimed": claimed})
    result = materialized(merkle.verified(manifest, "claimed").withColumnRenamed("id", "doc_id"),
                          "merkle-proofs")
    scratch.close()
    return result


QUERIES = {
    "op1_warc": op1_warc,
    "op2_minhash_circulant": op2_minhash_circulant,
    "op3_bpe": op3_bpe,
    "op4_quality_rules": op4_quality_rules,
    "op5_pii": op5_pii,
    "op6_url_filters": op6_url_filters,
    "op7_sharding": op7_sharding,
    "op8_string_tiling": op8_string_tiling,
    "op9_line_templates": op9_line_templates,
    "op10_deleted_interpolation": op10_deleted_interpolation,
    "op11_vertical_jaccard": op11_vertical_jaccard,
    "op12_collocations": op12_collocations,
    "op13_merkle_manifest": op13_merkle_manifest,
}
