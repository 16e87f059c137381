"""Daily event table, snapshots, sorted cell export and views."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickweir import manifests, workspace
from clickweir.sources.events import day_manifests, snapshot_path


def _write_folder(events: DataFrame, table: str, process_date: str) -> str:
    """Write rows to a new folder of the day that no manifest names yet."""
    folder = f"event_date={process_date}/write=w{uuid.uuid4().hex}"
    events.sortWithinPartitions("en").write.mode("error").parquet(f"{table}/{folder}")
    return folder


def _plain(schema: T.StructType) -> T.StructType:
    """A schema without nullability and metadata, as Parquet gives it back."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def write_daily_events(
    events: DataFrame, table: str, process_date: str, overwrite: bool = True
) -> None:
    """Write one day's events, other days stay untouched.

    An existing day is replaced, or with ``overwrite=False`` raises an error. The rows go to a
    new folder, and one rename of a manifest puts it in force: a failed job or a crash at any
    step leaves the old day, a reader has the old day or the new one, never a part or none.
    A day without events is empty. Replaced folders stay until ``retire_folders``.
    Each file is ordered by event (a local sort), which lets scans of one event
    skip the pages of all others.
    """
    spark, days = events.sparkSession, day_manifests(table, process_date)
    number, old = manifests.newest(spark, days)
    if not overwrite and old is not None:
        raise FileExistsError(f"{table}: {process_date}")
    folder = _write_folder(events, table, process_date)
    manifests.commit(spark, days, number, {
        "table": table, "writes": [folder], "schema": _plain(events.schema).jsonValue()})


def append_daily_events(events: DataFrame, table: str, process_date: str) -> None:
    """Add events to a day without reading or rewriting what it holds.

    Columns new to the day are null in its older rows; a column whose type changed raises
    ValueError. Repeating it adds the rows again: use ``write_daily_events`` to load anew.
    """
    spark, days = events.sparkSession, day_manifests(table, process_date)
    number, old = manifests.newest(spark, days)
    if old is None:
        return write_daily_events(events, table, process_date, overwrite=False)
    fields = {f.name: f for f in T.StructType.fromJson(old["schema"])}
    for field in _plain(events.schema):
        known = fields.setdefault(field.name, field)
        if known.dataType != field.dataType:
            raise ValueError(f"{field.name} is {known.dataType}, not {field.dataType}")
    folder = _write_folder(events, table, process_date)
    manifests.commit(spark, days, number, {
        "table": table, "writes": [*old["writes"], folder],
        "schema": T.StructType([*fields.values()]).jsonValue()})


def publish_snapshot(
    spark: SparkSession, table: str, process_date: str, snapshot_root: str
) -> str:
    """Publish a loaded day as an immutable snapshot; an existing one is FileExistsError.

    The snapshot is a copy of the day's manifest; no row is copied. The table keeps a pin, so
    that ``retire_folders`` leaves the snapshot's folders alone, and sets it first.
    """
    manifest = manifests.newest(spark, day_manifests(table, process_date))[1]
    if manifest is None:
        raise FileNotFoundError(f"{table}: {process_date}")
    path = snapshot_path(snapshot_root, process_date)
    if workspace.exists(spark, path):
        raise FileExistsError(path)
    text = json.dumps(manifest)
    workspace.write_new_text(spark, f"{_pins(table)}/{process_date}-{uuid.uuid4().hex}", text)
    workspace.write_new_text(spark, path, text)
    return path


def _pins(table: str) -> str:
    return f"{table}/_pins"


def retire_folders(spark: SparkSession, table: str, process_date: str) -> list[str]:
    """Delete a day's folders that no kept manifest and no snapshot names; returns them.

    The manifest in force and the one before it are kept, for readers at work. Run it when no
    write of the day is under way, whose folder no manifest names yet.
    """
    root = f"{table}/event_date={process_date}"
    if not workspace.exists(spark, root):
        return []
    held = manifests.kept(spark, day_manifests(table, process_date))
    if workspace.exists(spark, _pins(table)):
        held += [json.loads(workspace.read_text(spark, f"{_pins(table)}/{name}"))
                 for name in workspace.list_dir(spark, _pins(table))
                 if name.startswith(f"{process_date}-")]
    named = {folder for manifest in held for folder in manifest["writes"]}
    lost = [f"event_date={process_date}/{name}" for name in workspace.list_dir(spark, root)
            if f"event_date={process_date}/{name}" not in named]
    for folder in lost:
        workspace.delete(spark, f"{table}/{folder}")
    return lost


def write_sorted_cells(cells: DataFrame, path: str) -> None:
    """Export cells in total (row key, column) order, one sorted range per file.

    The range covers both columns, so a row with very many cells still spreads.
    """
    (
        cells.repartitionByRange("row_key", "column")
        .sortWithinPartitions("row_key", "column")
        .write.mode("error").parquet(path)
    )


def register_view(df: DataFrame, name: str) -> str:
    """Make ``df`` available to every session's SQL; returns the qualified name."""
    df.createOrReplaceGlobalTempView(name)
    return f"global_temp.{name}"
