"""Small helpers that keep an operator's own columns apart from its input's."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that start inside hand at most ``rows`` rows at once to Python."""
    before = spark.conf.get(_ARROW_ROWS)
    spark.conf.set(_ARROW_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)


def shielded(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` under positional names, so that no helper column can clash with one of it."""
    names = [f"_in{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def unshielded(df: DataFrame, names: list[str], original: list[str], *added: Column) -> DataFrame:
    """The shielded columns under their own names again, and ``added`` ones.

    A column of the input that has the name of an added one gives way to it.
    """
    new = df.select(*added).columns
    kept = [(n, o) for n, o in zip(names, original) if o not in new]
    return df.select(*[F.col(n).alias(o) for n, o in kept], *added)


def position(df: DataFrame, name: str) -> str:
    """The positional name of column ``name`` in ``shielded(df)``."""
    return f"_in{df.columns.index(name)}"
