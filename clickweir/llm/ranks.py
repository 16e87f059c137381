"""Dense ranks within groups, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.scratch import Scratch
from clickweir.operators.joins import bounded_broadcast

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_BITS = 33


def ranked(rows: DataFrame, group: str, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows``, a stored table, with ``rank``: 0, 1, ... within ``group`` by ``order``.

    Rows are dealt by ranges of (group, order) and sorted inside a partition, so that a
    group may span any number of tasks; a row's rank is its place there and the rows of its
    group in partitions before. ``group`` has no nulls, nulls of ``order`` come first, and
    rows that are equal in all of these are interchangeable, so they should be whole keys.
    """
    placed = scratch.keep(
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn(
            "_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", _ROW_BITS)
    # A group has at most one row here per partition.
    runs = scratch.keep(placed.groupBy(group, part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")), "runs")
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    shifts = scratch.keep(runs.select(group, "_part", (
        F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift")),
        "shifts")
    return placed.withColumn("_part", part).join(
        bounded_broadcast(shifts, BROADCAST_BYTES), [group, "_part"]).withColumn(
        "rank", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")
