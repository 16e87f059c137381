"""User-defined keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# (key, values of the micro-batch in chunks, old state or None) -> new state.
StateFunction = Callable[[tuple, Iterator[pd.DataFrame], tuple | None], tuple]


def stateful_map(
    df: DataFrame,
    key: str,
    update: StateFunction,
    state_schema: str,
    combine: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
) -> DataFrame:
    """Keep one state tuple per key and emit (key, state) for keys seen in a batch.

    For sums and counts use a streaming aggregate, which stays in the JVM; this is
    for updates no aggregate expresses. ``combine`` reduces each Arrow batch on the
    map side before the shuffle, so that a key holding most of the rows arrives as
    a few rows per task; it must keep the columns. ``update`` receives a key's rows
    in chunks and never needs them all at once.
    """
    if combine is not None:
        def combine_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield combine(batch)

        df = df.mapInPandas(combine_batches, df.schema)

    key_type = df.schema[key].dataType.simpleString()
    names = [part.split()[0] for part in state_schema.split(",")]

    def advance(
        group: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        new = update(group, chunks, state.get if state.exists else None)
        state.update(new)
        yield pd.DataFrame([(*group, *new)], columns=[key, *names])

    return df.groupBy(key).applyInPandasWithState(
        advance,
        f"{key} {key_type}, {state_schema}",
        state_schema,
        "update",
        GroupStateTimeout.NoTimeout,
    )


def running_sum(column: str) -> StateFunction:
    """State function adding up one column."""

    def update(key: tuple, chunks: Iterator[pd.DataFrame], old: tuple | None) -> tuple:
        total = old[0] if old else 0.0
        for chunk in chunks:
            total += float(chunk[column].sum())
        return (total,)

    return update


def summed_by(key: str, column: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Map-side combiner for ``running_sum``: one row per key of an Arrow batch."""

    def combine(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.groupby(key, as_index=False)[column].sum()[list(batch.columns)]

    return combine
