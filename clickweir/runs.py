"""Keyed tables of sorted runs, for keyed writes of high volume.

Each micro-batch adds one run, a Parquet folder holding each of its keys once. As soon as
``FAN_IN`` runs of a level are there they are folded into one run of the next level, so a row
is written again once a level, a number that grows with the logarithm of the batches: what a
batch costs does not depend on what the table holds, and a table of n batches has fewer than
FAN_IN * (1 + log n) runs. Reading merges the runs by key.

Runs are immutable and listed by a manifest (``clickweir.manifests``), which also holds the
last batch. A repeated batch is known by its number and left out; a run written before a crash
is in no manifest, is not read, and goes with the next fold. One query writes a table; a second
writer is told by FileExistsError.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir import manifests, workspace
from clickweir.operators.keyed import latest_by_key

FAN_IN = 8
# Manifests, hence folded runs, that stay for readers at work: four batches or more.
_KEPT = 16
_RUN = "run"


def _manifests(path: str) -> str:
    return f"{path}/_manifests"


def _scan(spark: SparkSession, path: str, manifest: dict, runs: list[dict]) -> DataFrame:
    layout = T.StructType.fromJson(manifest["schema"]).add(_RUN, "string")
    return spark.read.schema(layout).option("basePath", path).parquet(
        *(f"{path}/{run['folder']}" for run in runs))


def _newest(rows: DataFrame, manifest: dict) -> DataFrame:
    """One row per key; rows that agree in the order columns are told by their run.

    Names of runs ascend with the batches.
    """
    order = [*manifest["order"], _RUN]
    return latest_by_key(rows, manifest["keys"], order).drop(_RUN)


def _write_run(rows: DataFrame, path: str, manifest: dict, last: int, level: int) -> dict:
    folder = f"{_RUN}=b{last:012d}-{uuid.uuid4().hex}"
    split = manifest["partition_by"]
    # Sorted by key within files: a lookup skips row groups by their bounds.
    rows.sortWithinPartitions(*split, *manifest["keys"]).write.mode("error") \
        .partitionBy(*split).parquet(f"{path}/{folder}")
    return {"folder": folder, "level": level, "last": last}


def _folder_value(name: str) -> Column:
    value = F.col(name)
    unfit = value.isNull() | (value.cast("string") == "")
    return F.when(unfit, F.raise_error(F.lit(f"{name} is empty"))).otherwise(value)


def put_batch(
    updates: DataFrame,
    path: str,
    batch_id: int,
    keys: list[str],
    order: list[str],
    partition_by: list[str] | None = None,
) -> bool:
    """Store a micro-batch; False if it is there already.

    Of a key's rows the one largest in ``order`` counts, whichever batch it came with, nulls
    lowest; among equals that of the later batch, and within a batch the largest row.
    ``partition_by`` names key columns of few values that reads may filter by folder; null and
    empty text fail the batch there, as folders cannot tell them apart.
    Keys, order and columns of a table are fixed by its first batch (ValueError otherwise).
    """
    spark, split = updates.sparkSession, partition_by or []
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in updates.schema])
    number, manifest = manifests.newest(spark, _manifests(path))
    made = {"keys": keys, "order": order, "partition_by": split, "schema": schema.jsonValue()}
    if manifest is None:
        manifest = {**made, "last": -1, "runs": []}
    elif made != {name: manifest[name] for name in made}:
        raise ValueError(f"{path} has other keys, order or columns")
    if batch_id <= manifest["last"]:
        return False
    ties = [c for c in updates.columns if c not in {*keys, *order}]
    newest = latest_by_key(updates, keys, [*order, *ties]).select(updates.columns)
    run = _write_run(newest.withColumns({c: _folder_value(c) for c in split}),
                     path, manifest, batch_id, 0)
    manifests.commit(spark, _manifests(path), number,
                     {**manifest, "last": batch_id, "runs": [*manifest["runs"], run]}, _KEPT)
    return True


def fold(spark: SparkSession, path: str, fan_in: int = FAN_IN) -> int:
    """Fold levels that are full; returns the number of folds.

    The runs of a level are neighbours in time, lower levels being newer. Folders that no kept
    manifest names are deleted, so a reader has some batches' time to finish.
    """
    folds = 0
    while True:
        number, manifest = manifests.newest(spark, _manifests(path))
        runs = manifest["runs"] if manifest else []
        full = next((level for level in sorted({r["level"] for r in runs})
                     if sum(r["level"] == level for r in runs) >= fan_in), None)
        if full is None:
            return folds
        chosen = [r for r in runs if r["level"] == full]
        merged = _newest(_scan(spark, path, manifest, chosen), manifest)
        run = _write_run(merged, path, manifest, chosen[-1]["last"], full + 1)
        at = runs.index(chosen[0])
        rest = [r for r in runs if r["level"] != full]
        manifests.commit(spark, _manifests(path), number,
                         {**manifest, "runs": [*rest[:at], run, *rest[at:]]}, _KEPT)
        folds += 1
        held = manifests.kept(spark, _manifests(path), _KEPT)
        named = {r["folder"] for m in held for r in m["runs"]}
        for name in workspace.list_dir(spark, path):
            if name.startswith(f"{_RUN}=") and name not in named:
                workspace.delete(spark, f"{path}/{name}")


def read_current(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame | None:
    """The current row of every key, None before the first batch.

    ``where`` may use key columns alone: it is applied to each run before they are merged, so it
    prunes folders and row groups. A table of one run is read without a shuffle.
    """
    manifest = manifests.newest(spark, _manifests(path))[1]
    if manifest is None:
        return None
    rows = _scan(spark, path, manifest, manifest["runs"])
    if where is not None:
        rows = rows.where(where)
    columns = T.StructType.fromJson(manifest["schema"]).names
    merged = rows if len(manifest["runs"]) == 1 else _newest(rows, manifest)
    return merged.select(columns)


def runs_of(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(level, last batch) of each run, oldest first."""
    manifest = manifests.newest(spark, _manifests(path))[1]
    return [(r["level"], r["last"]) for r in manifest["runs"]] if manifest else []
