"""Online order statistics: wiring of source, running totals and window ranking."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from clickweir.operators.orders import (
    observed_orders,
    parse_csv_order,
    parse_sale_order,
    valid_orders,
)
from clickweir.session import build_session
from clickweir.sinks.jdbc import JdbcTarget, write_jdbc_overwrite
from clickweir.sources.streams import StreamSource, order_stream
from clickweir.streaming import runner, statistics

# Fixed value.
TOPIC = "saleOrderTopic"


def json_orders(messages: DataFrame) -> DataFrame:
    parsed = observed_orders(parse_sale_order(messages))
    return valid_orders(parsed).withColumnRenamed("timestamp", "ts")


def csv_orders(messages: DataFrame) -> DataFrame:
    return valid_orders(observed_orders(parse_csv_order(messages)))


def rate_cap(max_per_partition: int | None, partitions: int) -> int | None:
    """Most messages of a micro-batch over all partitions; none without a cap."""
    return max_per_partition * partitions if max_per_partition else None


def revenue_query(orders: DataFrame, totals: str, checkpoint: str, mode: str = "complete",
                  interval: str | None = runner.STATISTICS_INTERVAL):
    """Running totals per province, upserted into a keyed table."""
    return runner.foreach_batch(
        statistics.running_revenue(orders), statistics.upsert_totals(totals), checkpoint,
        mode, interval, "running_revenue",
    )


def ranking_query(orders: DataFrame, counts: str, publish, checkpoint: str,
                  watermark: str | None = None,
                  interval: str | None = runner.STATISTICS_INTERVAL):
    """Top provinces of the newest closed window, handed to ``publish``."""
    return runner.foreach_batch(
        statistics.windowed_counts(orders, watermark=watermark),
        statistics.windowed_top_n(counts, publish), checkpoint,
        "update", interval, "top_provinces",
    )


def run_order_statistics(
    spark: SparkSession, source: StreamSource, totals: str, counts: str, target: JdbcTarget,
    checkpoint_root: str, watermark: str | None = None,
) -> None:
    """Run both statistics until one of them ends.

    Without ``watermark`` late orders count whenever they come; with one, the state of
    older windows goes and orders later than it are left out.
    """
    orders = json_orders(order_stream(spark, source))
    revenue = revenue_query(orders, totals, f"{checkpoint_root}/revenue")
    ranking = ranking_query(
        orders, counts, lambda top: write_jdbc_overwrite(top, target),
        f"{checkpoint_root}/ranking", watermark,
    )
    with runner.running(revenue), runner.running(ranking):
        spark.streams.awaitAnyTermination()


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description="Running revenue and top provinces")
    for name in ("brokers", "totals", "counts", "jdbc-url", "jdbc-table", "checkpoints"):
        args.add_argument(f"--{name}", required=True)
    args.add_argument("--topic", default=TOPIC)
    args.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE")
    args.add_argument("--watermark", help="delay after which late orders are left out")
    args.add_argument("--max-per-partition", type=int,
                      help="most messages per topic partition and micro-batch")
    args.add_argument("--partitions", type=int, default=1, help="of the topic, for the cap")
    args.add_argument("--zone", default="UTC")
    given = args.parse_args(argv)
    spark = build_session("order-statistics", zone=given.zone)
    target = JdbcTarget(given.jdbc_url, given.jdbc_table,
                        dict(p.split("=", 1) for p in given.jdbc_property))
    source = StreamSource(topic=given.topic, brokers=given.brokers,
                          max_per_trigger=rate_cap(given.max_per_partition, given.partitions))
    run_order_statistics(spark, source, given.totals, given.counts, target, given.checkpoints,
                         given.watermark)


if __name__ == "__main__":
    main()
