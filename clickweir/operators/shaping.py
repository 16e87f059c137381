"""Metrics, previews and partition shaping."""

from __future__ import annotations

from contextlib import contextmanager
from math import ceil

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.operators.logs import is_log_line, parse_uri_params

SMALL_RESULT_ROWS = 100_000
PIECE_ROWS = 50_000


def with_metrics(df: DataFrame, name: str, **extra: Column) -> tuple[DataFrame, Observation]:
    """Count the rows flowing through ``df`` without a job of its own."""
    seen = Observation(name)
    return df.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in extra.items()]
    ), seen


def log_metrics(lines: DataFrame, line: str = "value") -> DataFrame:
    """Loaded, parsed, known and rejected line counts in one pass."""
    uri = F.get(F.split(F.col(line), r"\^A"), F.lit(3))
    en = F.when(F.col("parsed"), parse_uri_params(uri)["en"])
    return lines.withColumn("parsed", is_log_line(F.col(line))).agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if("parsed").alias("parsed"),
        F.count_if(en.isin(list(schemas.EVENTS))).alias("known"),
        F.count_if(~F.col("parsed")).alias("rejected"),
    )


def sort_cells(cells: DataFrame) -> DataFrame:
    """Total order by (row key, column): range-partitioned, then sorted."""
    return cells.orderBy("row_key", "column")


def preview(df: DataFrame, n: int = 1) -> DataFrame:
    return df.limit(n)


def shrink_partitions(
    df: DataFrame, rows: int | None = None, max_rows: int = SMALL_RESULT_ROWS
) -> DataFrame:
    """One partition for a small result; larger ones stay spread out.

    ``rows`` is a known bound on the rows; without it they are counted, which is a
    job over ``df`` and meant for results that are cached or cheap.
    """
    if rows is None:
        rows = df.count()
    return df.coalesce(1) if rows <= max_rows else df


def pieces_of(df: DataFrame, piece_rows: int = PIECE_ROWS) -> int:
    """How many pieces of ``piece_rows`` rows ``df`` makes, one at least; counts the rows."""
    return max(1, ceil(df.count() / piece_rows))


def spread_small_input(df: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Use all cores for costly work on an input that comes in fewer or larger pieces.

    Rows of a columnar file are small and may grow a hundredfold on the way (lines, wide events,
    cells), so what a task sorts is bounded by rows, not by the file's bytes. The rows are counted,
    which for Parquet reads footers alone. An input with at least a piece per core and per
    ``piece_rows`` rows is left where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = max(cores, pieces_of(df, piece_rows))
    return df.repartition(pieces) if df.rdd.getNumPartitions() < pieces else df


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep an intermediate that several outputs read, and release it afterwards.

    A frame that is already kept stays so.
    """
    if df.is_cached or df.storageLevel != StorageLevel.NONE:
        yield df
        return
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
