"""Console output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from clickweir.functions.dates import batch_time


def show_frame(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)


def console_writer(df: DataFrame, mode: str = "update", rows: int = 20) -> DataStreamWriter:
    """A writer that prints each micro-batch."""
    return (
        df.writeStream.format("console").outputMode(mode)
        .option("truncate", False).option("numRows", rows)
    )


def batch_header(df: DataFrame, fmt: str) -> str:
    """The batch time, as text, for a printed header."""
    return df.sparkSession.range(1).select(batch_time(fmt).alias("at")).first()["at"]
