"""Running totals with typed state, timers and a seed: Spark's second user-defined state.

``state.stateful_map`` keeps one tuple per key. Here a key has a value state (its total) and
a map state (its recent periods); a timer drops a period when event time has passed it, and a
table can seed the state, so a new query goes on where an old one's results end.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# The only built-in store with several states and timers per key (fixed value).
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_db_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKS_DB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class PeriodTotals(StatefulProcessor):
    """Emits (key, total, recent) for keys with new rows or an expired period.

    ``total`` counts all rows, ``recent`` those of periods that began less than ``keep_ms``
    before the watermark. State per key: one number, and one per period kept.
    """

    def __init__(self, key: str, keep_ms: int):
        self.key, self.keep_ms = key, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "total double")
        self.recent = handle.getMapState("recent", "period long", "amount double")

    def _add(self, sums: pd.Series, watermark: int) -> None:
        old = self.total.get()
        self.total.update(((old[0] if old else 0.0) + float(sums.sum()),))
        for period, amount in sums.items():
            expiry = int(period) + self.keep_ms
            if expiry <= watermark:
                continue
            known = self.recent.getValue((int(period),))
            if known is None:
                self.handle.registerTimer(expiry)
            self.recent.updateValue((int(period),), ((known[0] if known else 0.0) + amount,))

    def _emitted(self, key: tuple) -> pd.DataFrame:
        recent = sum(value[0] for value in self.recent.values())
        return pd.DataFrame({self.key: [key[0]], "total": [self.total.get()[0]],
                             "recent": [float(recent)]})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._add(initialState.groupby("period")["amount"].sum(),
                  timerValues.getCurrentWatermarkInMs())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for chunk in rows:
            self._add(chunk.groupby("period")["amount"].sum(), watermark)
        yield self._emitted(key)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.recent.removeKey((expiredTimerInfo.getExpiryTimeInMs() - self.keep_ms,))
        yield self._emitted(key)

    def close(self) -> None:
        pass


def _summed(rows: DataFrame, key: str) -> DataFrame:
    """One row per key and period of an Arrow batch, with its newest time."""

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.groupby([key, "period"], as_index=False, dropna=False).agg(
                    {"amount": "sum", "at": "max"})[list(batch.columns)]

    return rows.mapInPandas(combine, rows.schema)


def period_rows(orders: DataFrame, key: str, amount: str, at: str, period: str) -> DataFrame:
    """(key, amount, at, period) rows; ``period`` is a ``date_trunc`` unit, kept in epoch ms.

    Rows without key, time or amount are left out.
    """
    return orders.select(
        F.col(key), F.col(amount).cast("double").alias("amount"),
        F.col(at).cast("timestamp").alias("at"),
        F.unix_millis(F.date_trunc(period, at)).alias("period"),
    ).dropna()


def period_totals(
    rows: DataFrame,
    key: str,
    keep_days: int,
    delay: str,
    seed: DataFrame | None = None,
) -> DataFrame:
    """Totals of ``period_rows`` as a stream in update mode; start it in ``rocks_db_state``.

    Rows are summed per Arrow batch before the shuffle, so a key holding most of them arrives as
    a few rows per task. Rows more than ``delay`` behind the newest are left out, those summed
    together by the newest of them. ``seed`` holds ``period_rows`` of the past; it is read by the first batch alone and summed by the
    engine to one row per key and period, and emits nothing by itself.
    """
    timed = _summed(rows, key).withWatermark("at", delay)
    past = None
    if seed is not None:
        past = seed.groupBy(key, "period").agg(F.sum("amount").alias("amount")).groupBy(key)
    key_type = rows.schema[key].dataType.simpleString()
    return timed.groupBy(key).transformWithStateInPandas(
        PeriodTotals(key, keep_days * 86_400_000),
        f"{key} {key_type}, total double, recent double",
        "update", "EventTime", past,
    )
