"""As-of merge: each row takes the last value of its key at or before its time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_SECONDS = 86_400


def latest_before(rows: DataFrame, values: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """``rows`` (key, at, ...) with the last of ``values`` (key, at, tie, value) before them.

    A value at the very time counts; of several at one time the one with the greatest
    ``tie`` does. Adds value, null where none came before or the key or time is null.

    Time is cut into chunks, so a key with very many rows is as many groups as it has
    chunks. Inside a chunk one window finds the last value; what a chunk inherits is the
    last value of the chunks before, found over one row per key and chunk.
    """
    chunk = F.floor(F.unix_micros("at") / F.lit(chunk_seconds * 1_000_000))
    valued = values.where(F.col("key").isNotNull() & F.col("at").isNotNull()).select(
        "key", "at", chunk.alias("chunk"), F.lit(0).alias("kind"), F.col("tie").alias("tie"),
        F.struct("value").alias("found"))
    asking = rows.select("key", "at", chunk.alias("chunk"), F.lit(1).alias("kind"),
                         F.struct(*rows.columns).alias("row"))
    ends = valued.groupBy("key", "chunk").agg(
        F.max_by("found", F.struct("at", "tie")).alias("end"))
    chunks = ends.unionByName(
        asking.select("key", "chunk").distinct().withColumn("end", F.lit(None)),
        allowMissingColumns=True).groupBy("key", "chunk").agg(F.first("end", True).alias("end"))
    earlier = Window.partitionBy("key").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    inherited = chunks.withColumn("inherited", F.last("end", True).over(earlier)).where(
        F.col("inherited").isNotNull()).select("key", "chunk", "inherited")
    before = Window.partitionBy("key", "chunk").orderBy("at", "kind", "tie").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    merged = valued.unionByName(asking, allowMissingColumns=True).withColumn(
        "own", F.last("found", True).over(before)).where("kind = 1")
    return merged.join(inherited, ["key", "chunk"], "left").select(
        "row.*", F.when(merged["key"].isNotNull() & merged["at"].isNotNull(), F.coalesce(
            "own", "inherited")["value"]).alias("value"))
