"""Joins whose plan shape is chosen from measured sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A side is broadcast only when it was measured and stays below this size.
BROADCAST_BYTES = 256 * 1024 * 1024
# Longest candidate list one probe may meet in the broadcast range join.
BUCKET_RANGES = 1_024
BUCKET_BITS = 16
ADDRESS_BITS = 32


def row_bytes(df: DataFrame) -> Column:
    """Estimated size of a row: its text plus a fixed share per column."""
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    return sum(texts, F.lit(32 * len(texts)))


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if ``df``, measured in one pass, is small enough.

    Otherwise the plain frame is returned, and Spark joins it by shuffling,
    splitting skewed partitions. ``df`` is read twice: hand in a stored frame.
    """
    size = df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if size <= max_bytes else df


def bucket_ranges(ranges: DataFrame, begin: str, end: str, bits: int = BUCKET_BITS) -> DataFrame:
    """Repeat each range once per 2^bits-wide bucket it touches."""
    return ranges.withColumn(
        "_bucket",
        F.explode(F.sequence(F.shiftright(begin, bits), F.shiftright(end, bits))),
    )


def overlapping_ranges(ranges: DataFrame, begin: str, end: str) -> DataFrame:
    """Ranges that start before an earlier range has ended (should be none).

    Ranges that overlap share a bucket, so each bucket is checked on its own.
    """
    earlier = Window.partitionBy("_bucket").orderBy(begin, end).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        bucket_ranges(ranges, begin, end)
        .withColumn("_reach", F.max(end).over(earlier))
        .where(F.col("_reach") >= F.col(begin))
        .drop("_bucket", "_reach")
        .distinct()
    )


def _rank(width: Column, begin: Column) -> Column:
    """A long whose order is by width and then begin; it names one extent of the address space."""
    return F.shiftleft(width - F.lit(1 << 31), 32).bitwiseOR(begin)


def covering_prefixes(ranges: DataFrame, begin: str, end: str) -> DataFrame:
    """(_prefix, _rank): for every binary prefix that a range is made of, its narrowest range.

    A range of 32-bit numbers is a union of at most 62 aligned blocks; a block of 2^k numbers
    is the prefix k * 2^33 + number / 2^k.
    """
    low, high = f"{begin} + shiftleft(1L, k) - 1", f"{end} + 1"
    blocks = f"""
        flatten(transform(sequence(0, {ADDRESS_BITS}), k -> filter(array(
            IF(shiftright({low}, k) < shiftright({high}, k) AND shiftright({low}, k) % 2 = 1,
               shiftleft(CAST(k AS BIGINT), 33) + shiftright({low}, k), NULL),
            IF(shiftright({low}, k) < shiftright({high}, k) AND shiftright({high}, k) % 2 = 1,
               shiftleft(CAST(k AS BIGINT), 33) + shiftright({high}, k) - 1, NULL)
        ), x -> x IS NOT NULL)))"""
    return ranges.select(
        F.explode(F.expr(blocks)).alias("_prefix"),
        _rank(F.col(end) - F.col(begin), F.col(begin)).alias("_rank"),
    ).groupBy("_prefix").agg(F.min("_rank").alias("_rank"))


def narrowest_ranges(points: DataFrame, point: str, prefixes: DataFrame) -> DataFrame:
    """(point, _begin, _end) of the narrowest range that holds each distinct point.

    A point has 33 prefixes and meets ``covering_prefixes`` by equality. Those of 2^16 and
    more numbers are fewer than 2^17 in all, so that side is broadcast whatever the
    dictionary; of shorter ones each has at most 2^15 points, so none is hot.
    """
    wide = F.col("_prefix") >= F.lit(BUCKET_BITS << 33)
    distinct = points.select(F.col(point).alias("_point")).where(
        F.col("_point").between(0, (1 << ADDRESS_BITS) - 1)).distinct()

    def met(first: int, last: int, side: DataFrame) -> DataFrame:
        own = [F.shiftright("_point", k) + F.lit(k << 33) for k in range(first, last + 1)]
        return distinct.select("_point", F.explode(F.array(*own)).alias("_prefix")).join(
            side, "_prefix").select("_point", "_rank")

    hits = met(BUCKET_BITS, ADDRESS_BITS, F.broadcast(prefixes.where(wide))).unionByName(
        met(0, BUCKET_BITS - 1, prefixes.where(~wide)))
    first = F.col("_rank").bitwiseAND(F.lit((1 << ADDRESS_BITS) - 1))
    width = F.shiftright("_rank", 32) + F.lit(1 << 31)
    return hits.groupBy("_point").agg(F.min("_rank").alias("_rank")).select(
        F.col("_point").alias(point), first.alias("_begin"), (first + width).alias("_end"))


def disjoint_ranges(ranges: DataFrame, begin: str, end: str) -> DataFrame:
    """``ranges`` cut into pieces ``_from``-``_to`` of which no two overlap.

    Where ranges overlap the narrowest wins, of equal ones the first by begin and then
    by the values of its other columns. Without overlaps each range is one piece. Ranges
    hold 32-bit numbers; one that is null, reversed or beyond them holds nothing.

    Only numbers are cut and compared: a piece starts where some range begins, has ended or
    enters a bucket, so a bucket has at most 2^16 pieces however many ranges crowd it, and
    all of a piece has the winner of its first number. Texts are joined back to the winners,
    one row per extent.
    """
    ranges = ranges.where((F.col(begin) >= 0) & (F.col(begin) <= F.col(end))
                          & (F.col(end) < F.lit(1 << ADDRESS_BITS)))
    if overlapping_ranges(ranges, begin, end).isEmpty():
        return ranges.withColumns({"_from": F.col(begin), "_to": F.col(end)})
    others = [c for c in ranges.columns if c not in (begin, end)]
    texts = ranges.groupBy(F.col(begin).alias("_begin"), F.col(end).alias("_end")).agg(
        F.min(F.struct(F.lit(0).alias("_"), *others)).alias("_row"))
    extents = ranges.select(F.col(begin).cast("long").alias("_b"),
                            F.col(end).cast("long").alias("_e")).distinct()
    entered = bucket_ranges(extents, "_b", "_e").select(
        F.greatest("_b", F.shiftleft("_bucket", BUCKET_BITS)).alias("_from"))
    ended = extents.select((F.col("_e") + 1).alias("_from"))
    edges = entered.unionByName(ended).distinct().withColumn(
        "_bucket", F.shiftright("_from", BUCKET_BITS))
    last = F.shiftleft(F.col("_bucket") + 1, BUCKET_BITS)
    following = F.lead("_from").over(Window.partitionBy("_bucket").orderBy("_from"))
    pieces = edges.withColumn("_to", F.coalesce(following, last) - 1)
    winners = narrowest_ranges(pieces, "_from", covering_prefixes(extents, "_b", "_e"))
    return winners.join(pieces.drop("_bucket"), "_from").join(texts, ["_begin", "_end"]).select(
        *[F.col("_begin").cast(ranges.schema[begin].dataType).alias(begin) if c == begin else
          F.col("_end").cast(ranges.schema[end].dataType).alias(end) if c == end else
          F.col("_row")[c].alias(c) for c in ranges.columns], "_from", "_to")


def range_join(
    df: DataFrame,
    point: str,
    ranges: DataFrame,
    begin: str,
    end: str,
    max_bytes: int = BROADCAST_BYTES,
    max_per_bucket: int = BUCKET_RANGES,
) -> DataFrame:
    """Left-join each point to the narrowest range holding it, at most one.

    Overlapping ranges are made disjoint first, whatever plan follows. One pass over the ranges measures the bucketed size. If it is small enough to
    broadcast and no bucket is crowded, the points stay where they are and meet
    the ranges in a broadcast equi-join. Otherwise see ``range_lookup``.
    """
    ranges = disjoint_ranges(ranges, begin, end)
    bucketed = bucket_ranges(ranges, "_from", "_to")
    per_bucket = bucketed.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("ranges"), F.sum(row_bytes(ranges)).alias("bytes")
    )
    size = per_bucket.agg(F.sum("bytes").alias("bytes"), F.max("ranges").alias("crowd")).first()
    if (size["bytes"] or 0) <= max_bytes and (size["crowd"] or 0) <= max_per_bucket:
        right = F.broadcast(bucketed.withColumnRenamed("_bucket", "_range_bucket"))
        return df.join(
            right,
            (F.shiftright(point, BUCKET_BITS) == F.col("_range_bucket"))
            & F.col(point).between(F.col("_from"), F.col("_to")),
            "left",
        ).drop("_range_bucket", "_from", "_to")
    # Left join back on the point value: a value that fills much of the data is
    # split by the adaptive skew join, which also handles exact copies.
    found = range_lookup(df.select(point), point, ranges, "_from", "_to")
    return df.join(found.drop("_from", "_to"), point, "left")


def range_lookup(
    points: DataFrame, point: str, ranges: DataFrame, begin: str, end: str
) -> DataFrame:
    """Distinct points with the columns of the range holding them.

    Points and range starts are merged in order inside each bucket and every
    point takes the last range started before it. Points are made distinct first,
    so a bucket holds at most 2^bits points and as many starts whatever the
    number of input rows, and no candidate pairs are produced.
    """
    carried = ranges.columns
    starts = bucket_ranges(ranges, begin, end).select(
        "_bucket",
        # A range reaching in from an earlier bucket starts at the bucket's edge.
        F.greatest(F.col(begin), F.shiftleft("_bucket", BUCKET_BITS)).alias("_at"),
        F.struct(*carried).alias("_range"),
    )
    probes = points.select(point).where(F.col(point).isNotNull()).distinct().select(
        F.shiftright(point, BUCKET_BITS).alias("_bucket"),
        F.col(point).alias("_at"),
        F.lit(None).cast(starts.schema["_range"].dataType).alias("_range"),
    )
    is_probe = F.col("_range").isNull()
    in_order = Window.partitionBy("_bucket").orderBy("_at", is_probe).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        starts.unionByName(probes)
        .withColumn("_found", F.last("_range", ignorenulls=True).over(in_order))
        .where(is_probe & (F.col("_found")[end] >= F.col("_at")))
        .select(F.col("_at").alias(point), "_found.*")
    )
