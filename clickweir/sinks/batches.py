"""What a stream has emitted, a partition per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweir.streaming.runner import BatchFunction


def store_batches(path: str) -> BatchFunction:
    """Write each micro-batch to its own partition: repeating one changes nothing."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return store


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All emitted rows, with their ``batch_id``."""
    return spark.read.parquet(path)
