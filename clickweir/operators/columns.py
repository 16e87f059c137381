"""Plan-shape helpers for single columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column that later filters and projections read back.

    Catalyst pushes a filter below a projection by repeating its expressions, but
    never below a generator, so a one-element array keeps the work single.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
