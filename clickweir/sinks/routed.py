"""Keyed writes of raw messages, routed by sink.

Each micro-batch goes to its own partition ``sink=<name>/batch_id=<n>``. A
repeated batch replaces its partition, and reading takes the newest message of a
key, so re-delivery never duplicates. A batch costs what it holds, not what the
table holds.

``write_runs`` and ``read_runs`` keep the same rows in a table of sorted runs, which the
stream folds as it goes (``clickweir.runs``): folders stay few and a read merges few runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickweir import runs
from clickweir.operators.keyed import latest_by_key
from clickweir.operators.orders import route_by_type, with_json_field

MESSAGE_ORDER = ["timestamp", "partition", "offset"]


def _typed(messages: DataFrame) -> DataFrame:
    return with_json_field(
        with_json_field(messages, "orderType", "order_type"), "orderId", "order_id"
    )


def _counts() -> list[Column]:
    has_id = F.col("order_id").isNotNull()
    return [F.count(F.lit(1)).alias("received"), F.count_if(has_id).alias("stored"),
            F.count_if(~has_id).alias("rejected")]


def routing_metrics(messages: DataFrame) -> DataFrame:
    """Messages received, stored, and rejected for want of an order id, in one pass."""
    return _typed(messages).agg(*_counts())


def keyed_orders(messages: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Messages with order_id and sink; one without an order id (or no JSON) is left out.

    ``seen`` observes what ``routing_metrics`` would count, on the way.
    """
    typed = _typed(messages)
    if seen is not None:
        typed = typed.observe(seen, *_counts())
    return route_by_type(typed.where(F.col("order_id").isNotNull()))


def newest_orders(orders: DataFrame) -> DataFrame:
    """The newest message of each order within each sink."""
    kept = [c for c in MESSAGE_ORDER if c in orders.columns]
    return latest_by_key(
        orders.select("sink", "order_id", "value", *kept), ["sink", "order_id"], kept
    )


def write_routed(orders: DataFrame, root: str, batch_id: int) -> None:
    """Store one micro-batch of ``keyed_orders``, newest message per order."""
    (
        newest_orders(orders)
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sink", "batch_id")
        .parquet(root)
    )


def read_routed(spark: SparkSession, root: str, sink: str | None = None) -> DataFrame:
    """Current message of every order, of one sink or of all."""
    stored = spark.read.parquet(root)
    if sink is not None:
        stored = stored.where(F.col("sink") == sink)
    order = ["batch_id"] + [c for c in MESSAGE_ORDER if c in stored.columns]
    return latest_by_key(stored, ["sink", "order_id"], order)


def compact_routed(spark: SparkSession, root: str, compacted: str) -> None:
    """Fold the history into one batch under a new root.

    Read from and append to the new root from then on; the folded messages carry
    the last batch id, so every later batch counts as newer.
    """
    last = spark.read.parquet(root).agg(F.max("batch_id").alias("last")).first()["last"]
    (
        read_routed(spark, root)
        .withColumn("batch_id", F.lit(last).cast("long"))
        .write.mode("error").partitionBy("sink", "batch_id").parquet(compacted)
    )


def write_runs(orders: DataFrame, path: str, batch_id: int, fan_in: int = runs.FAN_IN) -> bool:
    """Store one micro-batch of ``keyed_orders`` as a run and fold what is due.

    False if the table has the batch already; ``orders`` is then not read.

    The newest message of an order is that latest in ``MESSAGE_ORDER``, whichever batch brings
    it, so late or re-read messages never replace newer ones.
    """
    wanted = ["sink", "order_id", "value", *MESSAGE_ORDER]
    stored = runs.put_batch(orders.select(*wanted), path, batch_id, ["sink", "order_id"],
                            MESSAGE_ORDER, ["sink"])
    runs.fold(orders.sparkSession, path, fan_in)
    return stored


def read_runs(spark: SparkSession, path: str, sink: str | None = None) -> DataFrame | None:
    """Current message of every order, of one sink or of all; None before the first batch."""
    return runs.read_current(spark, path, None if sink is None else F.col("sink") == sink)
