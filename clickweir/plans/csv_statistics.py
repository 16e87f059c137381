"""Online statistics of CSV orders: running revenue per province, printed with the batch time."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame

from clickweir.functions.dates import BATCH_TIME_FORMAT
from clickweir.plans.order_statistics import TOPIC, csv_orders, rate_cap
from clickweir.session import build_session
from clickweir.sinks.console import batch_header, show_frame
from clickweir.sources.streams import StreamSource, order_stream
from clickweir.streaming import runner, state, statistics

# "all": every known province with each batch; "changed": those of the batch; "state": the
# same through user-defined state.
FORMS = ("all", "changed", "state")


def revenue(messages: DataFrame, form: str) -> DataFrame:
    """(province_id, total) of CSV order messages in one of ``FORMS``."""
    orders = csv_orders(messages)
    if form == "state":
        return state.stateful_map(
            orders.select("province_id", "order_price"), "province_id",
            state.running_sum("order_price"), "total double",
            combine=state.summed_by("province_id", "order_price"),
        )
    return statistics.running_revenue(orders)


def print_batch(batch: DataFrame, batch_id: int, rows: int = 20) -> None:
    """The batch time, then the provinces with the largest totals."""
    print(f"Time: {batch_header(batch, BATCH_TIME_FORMAT)}  batch {batch_id}")
    show_frame(batch.orderBy(batch["total"].desc(), "province_id"), rows)


def revenue_query(
    messages: DataFrame, form: str, checkpoint: str,
    publish: Callable[[DataFrame, int], None] = print_batch,
    interval: str | None = runner.STATISTICS_INTERVAL,
):
    """Running totals handed to ``publish`` with every batch; a restart keeps them."""
    if form not in FORMS:
        raise ValueError(f"{form} is none of {', '.join(FORMS)}")
    mode = "complete" if form == "all" else "update"
    return runner.foreach_batch(revenue(messages, form), publish, checkpoint, mode, interval,
                                f"csv_revenue_{form}")


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description="Running revenue of CSV orders, printed")
    for name in ("brokers", "checkpoint"):
        args.add_argument(f"--{name}", required=True)
    args.add_argument("--topic", default=TOPIC)
    args.add_argument("--form", choices=FORMS, default="all")
    args.add_argument("--max-per-partition", type=int,
                      help="most messages per topic partition and micro-batch")
    args.add_argument("--partitions", type=int, default=1, help="of the topic, for the cap")
    args.add_argument("--zone", default="UTC")
    given = args.parse_args(argv)
    spark = build_session("csv-statistics", zone=given.zone)
    source = StreamSource(topic=given.topic, brokers=given.brokers,
                          max_per_trigger=rate_cap(given.max_per_partition, given.partitions))
    runner.run_query(revenue_query(order_stream(spark, source), given.form, given.checkpoint))


if __name__ == "__main__":
    main()
