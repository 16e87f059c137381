"""Online order statistics: running revenue and top provinces per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir import storage
from clickweir.operators.keyed import latest_by_key
from clickweir.operators.orders import (
    province_revenue,
    top_provinces_per_window,
    windowed_order_count,
)
from clickweir.streaming.runner import BatchFunction

WINDOW_LENGTH = "15 seconds"
WINDOW_SLIDE = "10 seconds"
TOP_PROVINCES = 10

TOTAL_KEYS = ["province_id"]
WINDOW_KEYS = ["window_start", "window_end", "province_id"]


def running_revenue(orders: DataFrame) -> DataFrame:
    """Total price per province since the start.

    In complete mode every known province is emitted with each micro-batch, in
    update mode only those the batch changed. Totals never expire; there is one
    state entry per province, summed map-side before the shuffle.
    """
    return province_revenue(orders)


def upsert_totals(path: str) -> BatchFunction:
    """Keep the newest total of each province in a keyed table.

    The totals are absolute, so writing a repeated batch again changes nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        storage.upsert_table(batch, path, TOTAL_KEYS)

    return store


def upsert_newest(path: str, keys: list[str] = TOTAL_KEYS, grows: str = "total") -> BatchFunction:
    """Like ``upsert_totals`` for a stream that may emit a key several times in a batch.

    State that is updated and then expires in one batch emits both rows, in no stated order;
    the one with the larger ``grows``, or else with less ``recent``, is the later.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        newest = latest_by_key(batch, keys, [F.col(grows), -F.col("recent")])
        storage.upsert_table(newest, path, keys)

    return store


def windowed_counts(
    orders: DataFrame,
    length: str = WINDOW_LENGTH,
    slide: str = WINDOW_SLIDE,
    time: str = "ts",
    watermark: str | None = None,
) -> DataFrame:
    """Streaming order counts per sliding window and province.

    ``watermark`` lets the state of windows older than the given delay go; rows
    arriving later than that are then left out.
    """
    if watermark:
        orders = orders.withWatermark(time, watermark)
    return windowed_order_count(orders, length, slide, time)


def newest_closed_end(counts: DataFrame):
    """End of the newest window that an order at or after its end has closed, or None."""
    seen = counts.agg(F.max("last_ts").alias("seen")).first()["seen"]
    closed = counts.where(F.col("window_end") <= F.lit(seen))
    return closed.agg(F.max("window_end").alias("end")).first()["end"]


def upsert_window_counts(path: str) -> BatchFunction:
    """Keep the newest count of each (window, province) in a keyed table."""

    def store(batch: DataFrame, batch_id: int) -> None:
        storage.upsert_table(batch, path, WINDOW_KEYS)

    return store


def windowed_top_n(path: str, publish, n: int = TOP_PROVINCES) -> BatchFunction:
    """Maintain window counts and publish the top provinces of the newest closed window.

    ``publish`` receives at most ``n`` ranked rows whenever a window has closed.
    Windows before the published one are dropped from the counts table.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        storage.upsert_table(batch, path, WINDOW_KEYS)
        counts = storage.read_keyed(spark, path)
        newest = newest_closed_end(counts)
        if newest is None:
            return
        closed = counts.where(F.col("window_end") == F.lit(newest))
        publish(top_provinces_per_window(closed, n).coalesce(1))
        storage.upsert_table(
            counts.limit(0), path, WINDOW_KEYS, retain=F.col("window_end") >= F.lit(newest)
        )

    return store
