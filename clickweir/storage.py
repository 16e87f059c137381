"""Keyed Parquet tables.

A keyed table is a folder of generations, ``<path>/gen=<n>``. A write produces
the next generation from the newest complete one, so a lost executor, a failed
job or a repeated micro-batch never leaves readers without a whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from clickweir.operators.keyed import replace_by_key
from clickweir.operators.shaping import cached, shrink_partitions
from clickweir.workspace import delete, exists, list_dir

_KEPT_GENERATIONS = 2


def generations(spark: SparkSession, path: str) -> list[int]:
    """Complete generations of a keyed table, oldest first."""
    if not exists(spark, path):
        return []
    found = []
    for name in list_dir(spark, path):
        if name.startswith("gen=") and exists(spark, f"{path}/{name}/_SUCCESS"):
            found.append(int(name[4:]))
    return sorted(found)


def read_keyed(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The newest generation; without one an empty frame of ``schema``, or None."""
    done = generations(spark, path)
    if done:
        return spark.read.parquet(f"{path}/gen={done[-1]}")
    return spark.createDataFrame([], schema) if schema is not None else None


def upsert_table(
    updates: DataFrame, path: str, keys: list[str], retain: Column | None = None
) -> str:
    """Insert or replace rows by key, all or nothing; returns the new generation's path.

    ``updates`` holds each key once. ``retain`` optionally limits which rows the
    new generation keeps. The whole table is rewritten, so this is for result and
    state tables; high-volume keyed writes go through ``sinks.routed``.
    """
    spark = updates.sparkSession
    done = generations(spark, path)
    newest = done[-1] if done else 0
    target = f"{path}/gen={newest + 1}"
    # The updates are both written and matched against, so they are kept meanwhile.
    with cached(updates):
        merged, rows = updates, updates.count()
        if done:
            old = spark.read.parquet(f"{path}/gen={newest}")
            merged = replace_by_key(old, updates, keys)
            rows += old.count()  # answered from the file footers
        if retain is not None:
            merged = merged.where(retain)
        shrink_partitions(merged, rows).write.mode("overwrite").parquet(target)
    for old in done[: -_KEPT_GENERATIONS + 1 or None]:
        delete(spark, f"{path}/gen={old}")
    return target
