"""Online order ETL: routed keyed tables, optionally resuming from a saved ledger."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from clickweir.session import build_session
from clickweir.sources.offsets import load_offsets
from clickweir.sources.streams import StreamSource, order_stream
from clickweir.streaming import order_etl, runner

# Fixed value.
TOPIC = "etlTopic"


def order_etl_query(
    spark: SparkSession, source: StreamSource, root: str, checkpoint: str,
    ledger: str | None = None, interval: str | None = runner.OFFSET_ETL_INTERVAL,
    partitions: int = 0,
):
    """A first start reads from the ledger's offsets; restarts resume the checkpoint.

    ``partitions`` is the topic's number of partitions, so that idle ones start too.
    """
    if ledger is not None and source.format == "kafka":
        start = load_offsets(spark, ledger, source.topic, source.starting_offsets,
                             partitions)
        source = replace(source, starting_offsets=start)
    messages = order_stream(spark, source)
    return runner.foreach_batch(
        messages, order_etl.store_orders(root, ledger), checkpoint, "append", interval, "order_etl"
    )


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description="Route orders by payment type")
    for name in ("brokers", "root", "checkpoint"):
        args.add_argument(f"--{name}", required=True)
    args.add_argument("--topic", default=TOPIC)
    args.add_argument("--ledger")
    args.add_argument("--partitions", type=int, default=0, help="of the topic, for a ledger")
    args.add_argument("--max-per-trigger", type=int)
    args.add_argument("--zone", default="UTC")
    given = args.parse_args(argv)
    spark = build_session("order-etl", zone=given.zone)
    source = StreamSource(topic=given.topic, brokers=given.brokers,
                          max_per_trigger=given.max_per_trigger)
    interval = runner.OFFSET_ETL_INTERVAL if given.ledger else runner.ORDER_ETL_INTERVAL
    runner.run_query(order_etl_query(
        spark, source, given.root, given.checkpoint, given.ledger, interval, given.partitions
    ))


if __name__ == "__main__":
    main()
