"""The corpus pipeline: documents through quality, deduplication, decontamination, tokens.

Each stage works on all that its predecessor kept; all but the last return the columns
of ``documents``. The pipeline's rows are tokenised documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm import bpe, minhash, quality, templates, tiling
from clickweir.workspace import delete, new_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; one that had nothing else goes.

    ``n_chars`` follows the text.
    """
    cut = templates.drop_recurring(docs)
    changed = F.col("n_dropped") > 0
    return cut.where(~changed | F.col("text").rlike(quality.WORD)).withColumn(
        "n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return tiling.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of each document, their number and what they decode to."""
    return bpe.round_trip(
        docs.select("doc_id", "lang", "source", "text"), bpe.load_model(TOKENIZER)).withColumn(
        "n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# Near-duplicates, tiling and tokens are beyond SQL; a brute-force version tests the run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written before the next reads it."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        path = new_dir(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            delete(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
