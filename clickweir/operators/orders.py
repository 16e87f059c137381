"""Order messages: parsing, validation, revenue, ranking and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.functions.text import drop_trailing, not_blank
from clickweir.operators.columns import computed_once


def _other_columns(df: DataFrame, message: str) -> list[str]:
    return [c for c in df.columns if c != message]


def parse_sale_order(df: DataFrame, message: str = "value") -> DataFrame:
    """JSON messages to order_id, province_id and order_price; extra properties are ignored.

    A message that is not JSON, or lacks its province or price, gives nulls there;
    ``valid_orders`` and ``order_metrics`` tell them apart.
    """
    order = F.from_json(F.col(message), schemas.SALE_ORDER, {"mode": "PERMISSIVE"})
    return computed_once(df, "_order", order).select(
        *_other_columns(df, message),
        F.col("_order.orderId").alias("order_id"),
        F.col("_order.provinceId").alias("province_id"),
        F.col("_order.orderPrice").cast("double").alias("order_price"),
    )


def _csv_fields(message: Column) -> Column:
    # Trailing empty fields do not count as fields.
    return F.split(drop_trailing(F.trim(message), ","), ",")


def filter_valid_csv(df: DataFrame, message: str = "value") -> DataFrame:
    """Keep messages of exactly three fields."""
    c = F.col(message)
    return df.where(not_blank(c) & (F.size(_csv_fields(c)) == 3))


def parse_csv_order(df: DataFrame, message: str = "value") -> DataFrame:
    """``orderId,provinceId,orderPrice`` messages to typed columns.

    Province and price are null when malformed or when the message does not have
    exactly three fields.
    """
    fields = F.col("_fields")
    whole = F.size(fields) == 3
    # Numbers are taken as written: a padded province is malformed.
    province = F.get(fields, F.lit(1))
    return computed_once(df, "_fields", _csv_fields(F.col(message))).select(
        *_other_columns(df, message),
        F.get(fields, F.lit(0)).alias("order_id"),
        F.when(whole & province.rlike(r"^[+-]?\d+$"), province.try_cast("int"))
        .alias("province_id"),
        F.when(whole, F.get(fields, F.lit(2)).try_cast("double")).alias("order_price"),
    )


def is_valid_order() -> Column:
    return F.col("province_id").isNotNull() & F.col("order_price").isNotNull()


def valid_orders(orders: DataFrame) -> DataFrame:
    return orders.where(is_valid_order())


def observed_orders(orders: DataFrame, name: str = "orders") -> DataFrame:
    """Count accepted and rejected orders on the way; a stream reports them per batch."""
    return orders.observe(
        name,
        F.count_if(is_valid_order()).alias("accepted"),
        F.count_if(~is_valid_order()).alias("rejected"),
    )


def order_metrics(orders: DataFrame) -> DataFrame:
    """Number of loaded, accepted and rejected orders in one pass."""
    return orders.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(is_valid_order()).alias("accepted"),
        F.count_if(~is_valid_order()).alias("rejected"),
    )


def province_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy("province_id").agg(F.sum("order_price").alias("total"))


def province_order_count(orders: DataFrame, *more_keys: str) -> DataFrame:
    return orders.groupBy(*more_keys, "province_id").agg(F.count(F.lit(1)).alias("cnt"))


def windowed(df: DataFrame, length: str = "15 seconds", slide: str = "10 seconds",
             time: str = "ts") -> DataFrame:
    """Add the sliding windows of each row; overlapping windows repeat the row."""
    return df.withColumn("window", F.window(time, length, slide))


def windowed_order_count(orders: DataFrame, length: str = "15 seconds",
                         slide: str = "10 seconds", time: str = "ts") -> DataFrame:
    """Orders per (window, province) and the last order time seen for each."""
    return (
        orders.groupBy(F.window(time, length, slide), "province_id")
        .agg(F.count(F.lit(1)).alias("cnt"), F.max(time).alias("last_ts"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "province_id", "cnt", "last_ts",
        )
    )


def top_provinces(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` provinces with most orders; ties go to the smaller id."""
    return counts.orderBy(F.desc("cnt"), "province_id").limit(n)


def top_provinces_per_window(counts: DataFrame, n: int = 10) -> DataFrame:
    """``top_provinces`` within every window, with its rank.

    Spark drops ranks beyond ``n`` before the shuffle as well as after it.
    """
    ranking = Window.partitionBy("window_start", "window_end").orderBy(
        F.desc("cnt"), "province_id"
    )
    return counts.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= n)


def top_provinces_sql(orders: DataFrame, n: int = 10) -> DataFrame:
    """``top_provinces`` as SQL text; the frame is an argument and leaves no view behind."""
    return orders.sparkSession.sql(
        "SELECT province_id, count(*) AS cnt FROM {orders} GROUP BY province_id "
        "ORDER BY cnt DESC, province_id LIMIT :n", args={"n": int(n)}, orders=orders)


def with_json_field(df: DataFrame, field: str, name: str, message: str = "value") -> DataFrame:
    """Add one property of the JSON message as text, keeping the message."""
    return df.withColumn(name, F.get_json_object(message, f"$.{field}"))


def sink_of(order_type: Column) -> Column:
    """Table an order type belongs to; null and unknown types go to ``other``."""
    return F.when(order_type.isin(schemas.ORDER_TYPES), order_type).otherwise(schemas.OTHER_SINK)


def route_by_type(df: DataFrame, order_type: str = "order_type") -> DataFrame:
    """Add the ``sink`` of each order.

    The column is all a partitioned write needs. Rows are not gathered by sink:
    with four sinks that would leave four tasks, the largest holding most rows.
    """
    return df.withColumn("sink", sink_of(F.col(order_type)))
