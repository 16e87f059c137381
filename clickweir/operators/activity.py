"""Active and total users from mergeable daily states.

Users are numbered once, in a dictionary. A day's state is a set of bitmaps, one per 32 768
numbers, beside a sketch; weeks, months and running totals are unions of states, and no
day's visits are read again. A state is written as a partition of its day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir import workspace

_DICTIONARY = "user string, number long"
_ROW_BITS = 33
PERIODS = ("day", "week", "month")


def numbered(users: DataFrame, after: int) -> DataFrame:
    """(user, number): numbers from ``after`` + 1 for stored ``users`` (user, row).

    ``row`` is a stored monotonically increasing id; rows of one former partition get
    adjacent numbers, so no task sees all of them.
    """
    part = F.shiftright("row", _ROW_BITS)
    parts = users.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    # One row per partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return users.withColumn("part", part).join(F.broadcast(shifts), "part").select(
        "user", (F.col("row") - F.col("first") + F.col("shift") + 1 + after).alias("number"))


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(user, number) of all users recorded so far."""
    folder = f"{path}/users"
    if not workspace.exists(spark, folder):
        return spark.createDataFrame([], _DICTIONARY)
    return spark.read.schema(_DICTIONARY).parquet(folder)


def daily_states(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, bitmap, sketch, day): bitmaps by bucket, and the day's sketch with bucket 0."""
    return spark.read.schema("bucket long, bitmap binary, sketch binary, day date").parquet(
        f"{path}/days")


def record(visits: DataFrame, path: str) -> None:
    """Add whole days of ``visits`` (user, day); recording a day again replaces it.

    New users are numbered before any state names them, so a failed run leaves at most
    numbers that no day uses yet. Visits without user or day are left out.
    """
    spark = visits.sparkSession
    seen = workspace.materialized(visits.select(
        F.col("user").cast("string").alias("user"), "day").dropna().distinct(), "visits")
    known = dictionary(spark, path)
    fresh = workspace.materialized(seen.select("user").distinct().join(
        known, "user", "left_anti").withColumn("row", F.monotonically_increasing_id()), "new-users")
    last = known.agg(F.max("number").alias("last")).first()["last"] or 0
    numbered(fresh, last).write.mode("append").parquet(f"{path}/users")
    coded = seen.join(dictionary(spark, path), "user")
    bitmaps = coded.groupBy("day", F.expr("bitmap_bucket_number(number)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(number))").alias("bitmap"))
    sketches = seen.groupBy("day").agg(F.expr("hll_sketch_agg(user, 12)").alias("sketch"))
    states = bitmaps.unionByName(
        sketches.withColumn("bucket", F.lit(0).cast("long")), allowMissingColumns=True)
    states.select("bucket", "bitmap", "sketch", "day").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{path}/days")


def _start(period: str) -> Column:
    return F.trunc("day", period) if period != "day" else F.col("day")


def active_users(states: DataFrame, period: str) -> DataFrame:
    """(start, active_users, estimate): distinct users of each period, by bitmaps and sketch."""
    exact = states.where("bucket > 0").groupBy(_start(period).alias("start"), "bucket").agg(
        F.expr("bitmap_count(bitmap_or_agg(bitmap))").alias("n")).groupBy("start").agg(
        F.sum("n").alias("active_users"))
    rough = states.where("bucket = 0").groupBy(_start(period).alias("start")).agg(
        F.expr("hll_sketch_estimate(hll_union_agg(sketch))").alias("estimate"))
    return exact.join(rough, "start")


def total_users(states: DataFrame) -> DataFrame:
    """(day, total_users): distinct users up to and including each recorded day."""
    till_now = Window.partitionBy("bucket").orderBy("day")
    grown = states.where("bucket > 0").select("day", F.expr(
        "bitmap_count(bitmap_or_agg(bitmap) OVER (PARTITION BY bucket ORDER BY day))").alias("n"),
        "bucket").withColumn("new", F.col("n") - F.coalesce(F.lag("n").over(till_now), F.lit(0)))
    # One row per day.
    return grown.groupBy("day").agg(F.sum("new").alias("new")).select(
        "day", F.sum("new").over(Window.orderBy("day")).alias("total_users"))


def activity(states: DataFrame) -> DataFrame:
    """(period, start, active_users, estimate, total_users) by day, week and month."""
    totals = total_users(states)
    frames = None
    for period in PERIODS:
        upto = totals.groupBy(_start(period).alias("start")).agg(
            F.max("total_users").alias("total_users"))
        part = active_users(states, period).join(upto, "start").select(
            F.lit(period).alias("period"), "start", "active_users", "estimate", "total_users")
        frames = part if frames is None else frames.union(part)
    return frames
