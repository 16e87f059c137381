"""Last-write-wins and replace-by-key building blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.operators.joins import bounded_broadcast
from clickweir.operators.logs import to_cells
from clickweir.workspace import materialized


def latest_by_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The newest row of each key.

    ``order`` must rank the rows of a key. The aggregate combines map-side, so a
    key that holds a large share of the rows reaches its reducer as one row per
    map task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col("_newest")[c].alias(c) for c in rest])


def latest_cells(cells: DataFrame, order: str) -> DataFrame:
    """The newest value of each (row key, column) cell."""
    return cells.groupBy("row_key", "column").agg(F.max_by("value", order).alias("value"))


def replace_by_key(old: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``updates`` plus the old rows whose key is not updated.

    The anti join touches only the key columns of ``updates``; Spark broadcasts
    them when they are small and shuffles both sides otherwise.
    """
    kept = old.join(updates.select(*keys), keys, "left_anti")
    return updates.unionByName(kept)


def merge_colliding_rows(events: DataFrame, order: str) -> DataFrame:
    """Give wide events the row semantics of a keyed store.

    Rows with one row key merge column by column, the newest non-null value
    winning. Collisions are found on the key column alone; only colliding rows
    are taken apart into cells, all others pass through without a shuffle when
    the colliding keys are few enough to broadcast.
    """
    typed = [c for c in schemas.EVENT_COLUMNS if c in events.columns]
    wide = ["row_key", *typed, "attrs"]
    counted = events.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"))
    colliding = bounded_broadcast(
        materialized(counted.where("n > 1").select("row_key"), "colliding-keys")
    )
    single = events.join(colliding, "row_key", "left_anti").select(*wide)
    cells = latest_cells(
        to_cells(events.join(colliding, "row_key", "left_semi"), keep=[order]), order
    )
    # After latest_cells a row key has at most one cell per column.
    other = ~F.col("column").isin(typed)
    merged = cells.groupBy("row_key").agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in typed],
        F.map_from_entries(
            F.collect_list(F.when(other, F.struct("column", "value")))
        ).alias("attrs"),
    )
    return single.unionByName(merged.select(*wide))

