"""Visits of a user: page views and duration, from batches and streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = "30 minutes"


def session_metrics(visits: DataFrame, gap: str = GAP, lateness: str | None = None) -> DataFrame:
    """Sessions of ``visits`` (user, ts, page_view): a pause of more than ``gap`` ends one.

    Returns user, session_start, seconds between the first and the last visit, page_views
    and visits. Sessions of one task are merged before they are shuffled, so a user with
    very many visits is a few rows per task. Visits without user or time are left out.

    On a stream ``lateness`` is required: open sessions are state, joined by what arrives
    between them, and each is emitted once, when the watermark has passed its end.
    """
    known = visits.where(F.col("user").isNotNull() & F.col("ts").isNotNull())
    if lateness:
        known = known.withWatermark("ts", lateness)
    found = known.groupBy(F.session_window("ts", gap).alias("session"), "user").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("last"),
        F.sum(F.col("page_view").cast("long")).alias("page_views"),
        F.count(F.lit(1)).alias("visits"))
    return found.select(
        "user", "session_start",
        ((F.unix_micros("last") - F.unix_micros("session_start")) / 1_000_000).alias("seconds"),
        "page_views", "visits")
