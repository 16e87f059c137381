"""Raw access logs and the address dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir import schemas


def read_access_logs(spark: SparkSession, root: str, process_date: str) -> DataFrame:
    """One day's log folder as lines, with an ingestion rank for last-write-wins.

    The rank follows the files' times and names and a line's place in its file, however
    the files are split and packed into tasks.
    """
    place = F.struct(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return spark.read.text(f"{root}/{process_date}/").select(
        "value", place.alias("ingest_order"))


def read_ip_ranges(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The address dictionary from CSV (with header) or Parquet files."""
    reader = spark.read.schema(schemas.IP_RANGES)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def create_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A small typed frame from literal rows."""
    return spark.createDataFrame(rows, schema)
