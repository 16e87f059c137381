"""Orders from creation to payment and refund, as a join of two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAID, REFUNDED, UNPAID = "paid", "refunded", "unpaid"


def with_outcomes(created: DataFrame, outcomes: DataFrame, within: str,
                  lateness: str | None = None) -> DataFrame:
    """Orders (order_id, created_at, amount), a row per outcome in time, one row without any.

    ``outcomes`` has order_id, outcome and outcome_at. Those before the order or later than
    ``within`` after it do not count. On streams ``lateness`` is the watermark's delay on
    both sides: an order is kept until no outcome in time can come any more, then it is
    emitted without one and forgotten, as are outcomes that no order can ask for.
    """
    if lateness:
        created = created.withWatermark("created_at", lateness)
        outcomes = outcomes.withWatermark("outcome_at", lateness)
    of = outcomes.withColumnRenamed("order_id", "of_order")
    in_time = (F.col("outcome_at") >= F.col("created_at")) & (
        F.col("outcome_at") <= F.col("created_at") + F.expr(f"INTERVAL {within}"))
    return created.join(of, (F.col("order_id") == F.col("of_order")) & in_time, "leftOuter").select(
        "order_id", "created_at", "amount", "outcome", "outcome_at")


def order_states(joined: DataFrame) -> DataFrame:
    """Per order: its state, and the seconds until the first payment.

    A refund counts only for a paid order and not before its payment. Repeated messages of
    an outcome change nothing.
    """
    paid_at = F.min(F.when(F.col("outcome") == PAID, F.col("outcome_at")))
    refunded_at = F.max(F.when(F.col("outcome") == REFUNDED, F.col("outcome_at")))
    per_order = joined.groupBy("order_id").agg(
        F.first("amount").alias("amount"), F.first("created_at").alias("created_at"),
        paid_at.alias("paid_at"), refunded_at.alias("refunded_at"))
    state = (F.when(F.col("paid_at").isNull(), UNPAID)
             .when(F.col("refunded_at") >= F.col("paid_at"), REFUNDED).otherwise(PAID))
    return per_order.select("order_id", "amount", state.alias("state"), (
        F.unix_seconds("paid_at") - F.unix_seconds("created_at")).alias("seconds_to_pay"))


def state_totals(states: DataFrame) -> DataFrame:
    """Orders and amounts by state, and of all orders."""
    return states.groupingSets([["state"], []], "state").agg(
        F.when(F.grouping("state") == 1, "total").otherwise(F.col("state")).alias("label"),
        F.count(F.lit(1)).alias("orders"), F.sum("amount").alias("amount")).select(
        F.col("label").alias("state"), "orders", "amount")
