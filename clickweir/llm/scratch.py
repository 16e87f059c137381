"""Intermediate tables of one run, in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweir.workspace import delete, new_dir


class Scratch:
    """A folder for tables that cut lineage; ``close`` deletes it with all of them."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = new_dir(spark, label)
        self.tables = 0

    def folder(self, label: str) -> str:
        self.tables += 1
        return f"{self.path}/{self.tables:03d}-{label}"

    def keep(self, df: DataFrame, label: str, *partition_by: str) -> DataFrame:
        """``df`` written and read back: computed once, and safe from lost executors."""
        path = self.folder(label)
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a kept table that nothing will read again."""
        for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            delete(self.spark, file)

    def close(self) -> None:
        delete(self.spark, self.path)
