"""Scans of the daily event table and its snapshots.

A day's data lie in immutable folders, ``<table>/event_date=<day>/write=<id>``; the day's
manifest below ``<table>/_days`` names those in force. Folders that it does not name, of
writes that failed or were replaced, are never read.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir import manifests, schemas, workspace


def day_table_name(process_date: str, table: str = schemas.EVENT_TABLE) -> str:
    """``event_logs`` + ``yyyyMMdd``; an impossible date raises ValueError."""
    return table + dt.date.fromisoformat(process_date).strftime("%Y%m%d")


def day_manifests(table: str, process_date: str) -> str:
    """Where the manifests of a day are."""
    return f"{table}/_days/{process_date}"


def _listed(spark: SparkSession, manifest: dict) -> DataFrame:
    """The rows of a manifest's folders; the schema is known, no footer is read for it.

    A column that some of the folders lack is null there.
    """
    schema = T.StructType.fromJson(manifest["schema"])
    if not manifest["writes"]:
        return spark.createDataFrame([], schema.add("event_date", "date"))
    layout = T.StructType([*schema.fields, T.StructField("event_date", T.DateType()),
                           T.StructField("write", T.StringType())])
    return spark.read.schema(layout).option("basePath", manifest["table"]).parquet(
        *(f"{manifest['table']}/{folder}" for folder in manifest["writes"])).drop("write")


def _selected(
    day: DataFrame, columns: list[str] | None, event: str | None
) -> DataFrame:
    if event is not None:
        day = day.where(F.col("en") == event)
    return day.select(*columns) if columns else day


def _any_schema(spark: SparkSession, table: str) -> dict:
    """The schema of the newest day; FileNotFoundError where no day was ever written."""
    days = f"{table}/_days"
    for day in sorted(workspace.list_dir(spark, days) if workspace.exists(spark, days) else [],
                      reverse=True):
        manifest = manifests.newest(spark, f"{days}/{day}")[1]
        if manifest:
            return manifest["schema"]
    raise FileNotFoundError(f"{table} has no day")


def read_events(
    spark: SparkSession,
    table: str,
    process_date: str,
    columns: list[str] | None = None,
    event: str | None = None,
) -> DataFrame:
    """One day of events: the partition, columns and event filter reach the scan.

    Only the folders of the day's manifest are listed. A day that was never written is empty.
    """
    manifest = manifests.newest(spark, day_manifests(table, process_date))[1]
    if manifest is None:
        manifest = {"table": table, "writes": [], "schema": _any_schema(spark, table)}
    day = _listed(spark, manifest).where(
        F.col("event_date") == F.lit(process_date).cast("date"))
    return _selected(day, columns, event)


def read_snapshot(
    spark: SparkSession,
    snapshot_root: str,
    process_date: str,
    columns: list[str] | None = None,
    event: str | None = None,
) -> DataFrame:
    """The same scan over a published snapshot, which later ETL runs do not change."""
    text = workspace.read_text(spark, snapshot_path(snapshot_root, process_date))
    return _selected(_listed(spark, json.loads(text)).drop("event_date"), columns, event)


def snapshot_path(snapshot_root: str, process_date: str) -> str:
    return f"{snapshot_root}/snapshot_{day_table_name(process_date)}"
