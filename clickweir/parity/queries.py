"""Registered queries: each runs one or more operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir import schemas, storage, workspace
from clickweir.functions import dates, geo, network, text
from clickweir.operators import (activity, analytics, asof, baskets, enrich, keyed, lifecycle, logs,
                                 orders, sessions, shaping)
from clickweir.parity import fixtures
from clickweir.parity.fixtures import table
from clickweir.plans import log_etl, new_users, order_etl, order_statistics
from clickweir.session import configure
from clickweir.sinks import events as event_sinks
from clickweir.sinks import batches, routed
from clickweir.sources import events as event_sources
from clickweir.sources import logs as log_sources
from clickweir.sources import offsets
from clickweir.sources.streams import table_stream
from clickweir.streaming import order_etl as etl_streams
from clickweir.streaming import runner, state, statistics, totals

PROCESS_DATE = "2024-01-30"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(fn: Callable[[SparkSession, str], DataFrame]):
    """Register a query under its function name, on a configured session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.spread_small_input(table(spark, sf_dir, "events"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.spread_small_input(table(spark, sf_dir, "orders"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.log_lines(_events(spark, sf_dir))


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.ip_ranges(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_etl.parse_lines(_lines(spark, sf_dir))


def _launch_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = enrich.enrich_user_agent(_parsed(spark, sf_dir))
    return analytics.launch_dimensions(analytics.filter_event(events, schemas.LAUNCH))


# --- log ETL ---------------------------------------------------------------


@registered
def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = logs.parse_event(logs.split_log_line(_lines(spark, sf_dir)))
    return logs.project_event(lines).select(
        "event_id", "ip", "s_time", "http_host", "en", "ver", "u_ud", "u_mid", "u_sd", "c_time",
        "l", "b_iev", "b_rst", "pl", "tt",
        F.array_join(F.array_sort(F.map_keys("attrs")), ",").alias("rest_keys"),
        F.col("attrs")["sdk"].alias("sdk"),
    )


@registered
def log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.log_metrics(fixtures.dirty_log_lines(_events(spark, sf_dir)))


@registered
def log_known_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _parsed(spark, sf_dir)
        .groupBy("en")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select("en", text.event_id(F.col("en")).alias("event_no"),
                text.event_name(F.col("en")).alias("event_name"), "cnt")
    )


@registered
def access_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workspace.new_dir(spark, "access-logs")
    _lines(spark, sf_dir).select("value").write.text(f"{root}/{PROCESS_DATE}")
    scanned = logs.split_log_line(log_sources.read_access_logs(spark, root, PROCESS_DATE))
    return scanned.groupBy("http_host").agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("ip").alias("addresses")
    )


@registered
def event_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.with_row_key(_parsed(spark, sf_dir)).select("event_id", "row_key")


@registered
def log_cells_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = logs.with_row_key(_parsed(spark, sf_dir))
    path = workspace.new_dir(spark, "cells")
    event_sinks.write_sorted_cells(
        keyed.latest_cells(logs.to_cells(events, keep=["event_id"]), "event_id"), path
    )
    return shaping.sort_cells(spark.read.parquet(path))


@registered
def cells_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = logs.to_cells(logs.with_row_key(_parsed(spark, sf_dir)), keep=["event_id"])
    return logs.from_cells(cells, ["en", "u_sd", "c_time", "pl", "u_mid"], order="event_id")


@registered
def merged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = logs.with_row_key(enrich.enrich_user_agent(_parsed(spark, sf_dir)))
    merged = keyed.merge_colliding_rows(workspace.materialized(events, "events"), "event_id")
    return merged.select("row_key", "en", "ip", "u_sd", "c_time", "pl", "ver", "browser", "os_v",
                         F.col("attrs")["kv_color"].alias("kv_color"))


def _region_result(joined: DataFrame) -> DataFrame:
    return joined.select("event_id", "ip", "geo_country", "geo_area")


@registered
def ip_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = logs.split_log_line(_lines(spark, sf_dir))
    return _region_result(enrich.ip_range_join(split, _ranges(spark, sf_dir)))


@registered
def ip_region_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a dictionary too large to broadcast."""
    split = logs.split_log_line(_lines(spark, sf_dir))
    return _region_result(enrich.ip_range_join(split, _ranges(spark, sf_dir), max_bytes=0))


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.nested_ranges(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))


@registered
def ip_region_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges that nest and repeat: the narrowest wins."""
    split = logs.split_log_line(_lines(spark, sf_dir))
    return _region_result(enrich.ip_range_join(split, _nested(spark, sf_dir)))


@registered
def ip_region_nested_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answer from the plan for large dictionaries."""
    split = logs.split_log_line(_lines(spark, sf_dir))
    return _region_result(enrich.ip_range_join(split, _nested(spark, sf_dir), max_bytes=0))


@registered
def geo_decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.geo_texts(table(spark, sf_dir, "customer"))
    return texts.withColumn("r", geo.region_of(F.col("geo_text"))).select("c_custkey", "r.*")


@registered
def ip_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = enrich.enrich_ip(_parsed(spark, sf_dir), _ranges(spark, sf_dir))
    return events.select("event_id", "country", "province", "city")


@registered
def ua_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_user_agent(_parsed(spark, sf_dir)).select(
        "event_id", "browser", "browser_v", "os", "os_v"
    )


@registered
def ip_ranges_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.search_ip_ranges(_ranges(spark, sf_dir), "市")


@registered
def ip_range_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.list_ip_ends(_ranges(spark, sf_dir))


@registered
def ip_address_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(spark, sf_dir).select(
        "begin_ip_num", network.address_text(F.col("country"), F.col("area")).alias("address")
    )


@registered
def ip_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = network.ip_to_long(F.col("ip"))
    return logs.split_log_line(_lines(spark, sf_dir)).select(
        "event_id", number.alias("ip_num"), network.long_to_ip(number).alias("ip_back")
    )


@registered
def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a day and another, empty day, then scan the first day's launches."""
    path = workspace.new_dir(spark, "event-logs")
    day = enrich.enrich_user_agent(_parsed(spark, sf_dir)).drop("client_ip")
    event_sinks.write_daily_events(day, path, PROCESS_DATE)
    event_sinks.write_daily_events(day.limit(0), path, "2024-01-31")
    return event_sources.read_events(
        spark, path, PROCESS_DATE, schemas.LAUNCH_COLUMNS, schemas.LAUNCH
    )


@registered
def snapshot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a day, overwrite the live day, and count the snapshot's launches."""
    path, snapshots = workspace.new_dir(spark, "event-logs"), workspace.new_dir(spark, "snapshots")
    day = enrich.enrich_user_agent(_parsed(spark, sf_dir)).drop("client_ip")
    event_sinks.write_daily_events(day, path, PROCESS_DATE)
    event_sinks.publish_snapshot(spark, path, PROCESS_DATE, snapshots)
    event_sinks.write_daily_events(day.limit(0), path, PROCESS_DATE)
    return new_users.new_user_counts(
        new_users.launches(spark, snapshots, PROCESS_DATE, snapshot=True), "platform"
    )


@registered
def log_etl_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ETL program, from text files to the daily table."""
    root, path = workspace.new_dir(spark, "access-logs"), workspace.new_dir(spark, "event-logs")
    _lines(spark, sf_dir).select("value").write.text(f"{root}/{PROCESS_DATE}")
    log_etl.run_log_etl(spark, root, PROCESS_DATE, path, _ranges(spark, sf_dir))
    return event_sources.read_events(spark, path, PROCESS_DATE, ["row_key", "en", "u_ud", "u_mid"])


# --- new users ---------------------------------------------------------------


@registered
def launch_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _launch_dimensions(spark, sf_dir)


@registered
def new_users_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.new_users_by_platform(_launch_dimensions(spark, sf_dir))


@registered
def new_users_browser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.new_users_by_browser(_launch_dimensions(spark, sf_dir))


@registered
def new_users_browser_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.new_users_by_browser_sql(_launch_dimensions(spark, sf_dir))


@registered
def new_users_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both programs end to end: wide events, launches, counts, upserted twice."""
    path = workspace.new_dir(spark, "event-logs")
    result = workspace.new_dir(spark, "new-users")
    events = log_etl.wide_events(_lines(spark, sf_dir), _ranges(spark, sf_dir)).drop("event_id")
    event_sinks.write_daily_events(events, path, PROCESS_DATE)
    for _ in range(2):
        new_users.run_new_users(spark, path, PROCESS_DATE, result)
    return storage.read_keyed(spark, result)


@registered
def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer balances, replaced by order totals where a customer has orders."""
    path = workspace.new_dir(spark, "balances")
    balances = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("amount")
    )
    totals = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("amount")
    )
    for updates in (balances, totals):
        storage.upsert_table(updates, path, ["c_custkey"])
    return storage.read_keyed(spark, path)


# --- users, sessions and referrers -------------------------------------------------


@registered
def new_users_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over platforms and browsers; an unknown browser is null here."""
    dimensions = _launch_dimensions(spark, sf_dir)
    return analytics.new_users_rollup(dimensions.withColumn("browserDimension", F.expr(
        "nullif(browserDimension, 'unknown:unknown')")))


SESSION_GAP = "6 hours"
# Later than all events: passes every watermark.
HEARTBEAT = "2030-01-01 00:00:00"


def _session_result(found: DataFrame) -> DataFrame:
    return found.withColumn("session_start", F.date_format(
        "session_start", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@registered
def session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = fixtures.visits(_events(spark, sf_dir))
    return _session_result(sessions.session_metrics(visits, SESSION_GAP))


def _quarters(rows: DataFrame, at: str) -> list[DataFrame]:
    """Rows by time, in four parts."""
    low, high = rows.agg(F.unix_micros(F.min(at)), F.unix_micros(F.max(at))).first()
    quarter = F.least(F.width_bucket(F.unix_micros(at), F.lit(low), F.lit(high), F.lit(4)), F.lit(4))
    return [rows.where(quarter == k) for k in range(1, 5)]


@registered
def session_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions from a stream that is stopped and resumed after each quarter."""
    source, closed = workspace.new_dir(spark, "visits"), workspace.new_dir(spark, "sessions")
    checkpoint = workspace.new_dir(spark, "checkpoint")
    visits = fixtures.visits(_events(spark, sf_dir))
    end = visits.limit(1).withColumns({
        "user": F.lit("heartbeat"), "ts": F.lit(HEARTBEAT).cast("timestamp")})
    for part in [*_quarters(visits, "ts"), end]:
        part.write.mode("append").parquet(source)
        runner.run_query(runner.foreach_batch(
            sessions.session_metrics(table_stream(spark, source), SESSION_GAP, "1 hour"),
            batches.store_batches(closed), checkpoint, "append"))
    return _session_result(batches.read_batches(spark, closed).drop("batch_id"))


@registered
def order_referrer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the last referrer of its user."""
    events = _events(spark, sf_dir)
    return asof.latest_before(fixtures.buyers(events), fixtures.referrals(events)).select(
        "event_id", F.col("key").alias("user_id"), F.col("value").alias("referrer"))


@registered
def active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by day, week and month, from states recorded in two runs."""
    path = workspace.new_dir(spark, "activity")
    visits = fixtures.visits(_events(spark, sf_dir)).withColumn("day", F.to_date("ts"))
    early = F.col("day") < F.lit("2024-01-16").cast("date")
    for part in (visits.where(early), visits.where(~early)):
        activity.record(part, path)
    return activity.activity(activity.daily_states(spark, path)).select(
        "period", F.date_format("start", "yyyy-MM-dd").alias("start"), "active_users", "total_users")


def _joined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.with_outcomes(fixtures.created_orders(_orders(spark, sf_dir)),
                                   fixtures.order_outcomes(_orders(spark, sf_dir)), "2 DAYS")


@registered
def order_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.order_states(_joined_orders(spark, sf_dir)).drop("amount")


@registered
def order_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of created, paid and refunded orders from two streams, resumed three times."""
    names = ("created", "outcomes", "joined", "checkpoint")
    created, outcomes, joined, checkpoint = (workspace.new_dir(spark, n) for n in names)
    orders_ = fixtures.created_orders(_orders(spark, sf_dir))
    results = fixtures.order_outcomes(_orders(spark, sf_dir))
    at = F.lit(HEARTBEAT).cast("timestamp")
    beat = F.lit(-1).cast("long")
    last = (orders_.limit(1).withColumns({"order_id": beat, "created_at": at}),
            results.limit(1).withColumns({"order_id": beat - 1, "outcome_at": at}))
    for left, right in [*zip(_quarters(orders_, "created_at"), _quarters(results, "outcome_at")),
                        last]:
        left.write.mode("append").parquet(created)
        right.write.mode("append").parquet(outcomes)
        runner.run_query(runner.foreach_batch(
            lifecycle.with_outcomes(table_stream(spark, created), table_stream(spark, outcomes),
                                    "2 DAYS", "7 DAYS"),
            batches.store_batches(joined), checkpoint, "append"))
    states = lifecycle.order_states(batches.read_batches(spark, joined))
    return lifecycle.state_totals(states.where("order_id >= 0"))


# --- orders, batch -----------------------------------------------------------


def _sale_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.sale_order_messages(_orders(spark, sf_dir))
    return orders.valid_orders(orders.parse_sale_order(messages))


def _rounded(totals: DataFrame) -> DataFrame:
    return totals.withColumn("total", F.round("total", 2))


@registered
def province_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(orders.province_revenue(_sale_orders(spark, sf_dir)))


@registered
def csv_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.csv_messages(_orders(spark, sf_dir))
    return _rounded(orders.province_revenue(order_statistics.csv_orders(messages)))


@registered
def order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.sale_order_messages(_orders(spark, sf_dir))
    return orders.order_metrics(orders.parse_sale_order(messages))


@registered
def top10_provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.top_provinces(orders.province_order_count(_sale_orders(spark, sf_dir)))


@registered
def top10_provinces_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.top_provinces_sql(_sale_orders(spark, sf_dir))


@registered
def route_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.typed_order_messages(_orders(spark, sf_dir))
    return routed.keyed_orders(messages).groupBy("sink").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("order_id").alias("order_ids")
    )


@registered
def put_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest line item of each order."""
    lines = table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return keyed.latest_by_key(lines.select("l_orderkey", *order), ["l_orderkey"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


@registered
def offset_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = workspace.new_dir(spark, "ledger")
    etl_streams.commit_offsets(
        fixtures.typed_order_messages(_orders(spark, sf_dir)), ledger
    )
    return offsets.read_ledger(spark, ledger)


@registered
def saved_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.typed_order_messages(_orders(spark, sf_dir))
    return offsets.offsets_by_topic(etl_streams.until_offsets(messages))


# --- orders, streaming ---------------------------------------------------------


def _batches(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table as a stream of several micro-batches, one file each."""
    path = workspace.new_dir(spark, f"{name}-files")
    table(spark, sf_dir, name).repartition(4, key).write.parquet(path)
    return table_stream(spark, path, max_files=1)


def _order_messages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir, "orders", "o_orderkey")


def _stream_revenue(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    result = workspace.new_dir(spark, "totals")
    messages = fixtures.sale_order_messages(_order_messages_stream(spark, sf_dir))
    runner.run_query(order_statistics.revenue_query(
        orders.valid_orders(orders.parse_sale_order(messages)), result,
        workspace.new_dir(spark, "checkpoint"), mode, interval=None,
    ))
    return _rounded(storage.read_keyed(spark, result))


@registered
def running_revenue_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_revenue(spark, sf_dir, "complete")


@registered
def running_revenue_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_revenue(spark, sf_dir, "update")


@registered
def stateful_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = workspace.new_dir(spark, "totals")
    messages = fixtures.csv_messages(_order_messages_stream(spark, sf_dir))
    parsed = order_statistics.csv_orders(messages).select("province_id", "order_price")
    revenue = state.stateful_map(
        parsed, "province_id", state.running_sum("order_price"), "total double",
        combine=state.summed_by("province_id", "order_price"),
    )
    runner.run_query(runner.foreach_batch(
        revenue, statistics.upsert_totals(result), workspace.new_dir(spark, "checkpoint")
    ))
    return _rounded(storage.read_keyed(spark, result))


@registered
def stateful_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue of all time and of recent months per province, in typed state with timers.

    A table of the first quarter of the orders seeds the state; the rest comes as a stream that
    is stopped and resumed after each quarter.
    """
    source, result = workspace.new_dir(spark, "orders"), workspace.new_dir(spark, "totals")
    checkpoint = workspace.new_dir(spark, "checkpoint")
    rows = totals.period_rows(fixtures.dated_prices(_orders(spark, sf_dir)), "province_id",
                              "order_price", "ts", "month")
    first, *rest = _quarters(rows, "at")
    seed = workspace.materialized(first, "seed")
    for part in rest:
        part.write.mode("append").parquet(source)
        with totals.rocks_db_state(spark):
            runner.run_query(runner.foreach_batch(
                totals.period_totals(table_stream(spark, source), "province_id", 400,
                                     "0 seconds", seed),
                statistics.upsert_newest(result), checkpoint))
    return storage.read_keyed(spark, result).select("province_id", *[
        F.round(c, 2).alias(c) for c in ("total", "recent")])


def _window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace.new_dir(spark, "window-counts")
    stream = fixtures.purchases(_batches(spark, sf_dir, "events", "event_id"))
    runner.run_query(runner.foreach_batch(
        statistics.windowed_counts(stream, "15 hours", "10 hours"),
        statistics.upsert_window_counts(path), workspace.new_dir(spark, "checkpoint"),
    ))
    return storage.read_keyed(spark, path)


def _with_window_hours(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    ).select("window_start", "province_id", "cnt", *[c for c in ("rank",) if c in counts.columns])


@registered
def windowed_order_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_window_hours(_window_counts(spark, sf_dir))


@registered
def windowed_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_window_hours(orders.top_provinces_per_window(_window_counts(spark, sf_dir)))


@registered
def published_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest closed window's ranking, published by the stream itself."""
    counts, result = workspace.new_dir(spark, "window-counts"), workspace.new_dir(spark, "top")
    stream = fixtures.purchases(_batches(spark, sf_dir, "events", "event_id"))
    runner.run_query(runner.foreach_batch(
        statistics.windowed_counts(stream, "15 hours", "10 hours"),
        statistics.windowed_top_n(counts, lambda top: top.write.mode("overwrite").parquet(result)),
        workspace.new_dir(spark, "checkpoint"),
    ))
    return _with_window_hours(spark.read.parquet(result))


@registered
def routed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream orders into the four keyed tables and read back every current message."""
    root, ledger = workspace.new_dir(spark, "routed"), workspace.new_dir(spark, "ledger")
    # The order of files is not that of offsets, so this stream is one micro-batch.
    messages = fixtures.typed_order_messages(table_stream(spark, f"{sf_dir}/orders.parquet"))
    runner.run_query(runner.foreach_batch(
        messages, etl_streams.store_orders(root, ledger), workspace.new_dir(spark, "checkpoint"),
        "append",
    ))
    return routed.read_routed(spark, root).select("sink", "order_id", "partition", "offset")


@registered
def routed_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in eight micro-batches, stopped and resumed halfway, in a table the stream folds."""
    source, path = workspace.new_dir(spark, "orders"), workspace.new_dir(spark, "routed-runs")
    checkpoint, ledger = workspace.new_dir(spark, "checkpoint"), workspace.new_dir(spark, "ledger")

    def write(orders: DataFrame, root: str, batch_id: int) -> bool:
        return routed.write_runs(orders, root, batch_id, fan_in=3)

    halves = table(spark, sf_dir, "orders")
    # A micro-batch is an eighth of the orders in as many files as keep all cores at work on it.
    files = shaping.pieces_of(halves, 8 * shaping.PIECE_ROWS)
    for half in range(2):
        halves.where(F.abs(F.hash("o_custkey", "o_orderkey")) % 2 == half).repartition(
            4 * files, "o_orderkey").write.mode("append").parquet(source)
        messages = fixtures.typed_order_messages(table_stream(spark, source, max_files=files))
        runner.run_query(runner.foreach_batch(
            messages, etl_streams.store_orders(path, ledger, write=write), checkpoint, "append"))
    return routed.read_runs(spark, path).select("sink", "order_id", "partition", "offset")


@registered
def routed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the routed store takes and what it leaves out."""
    return routed.routing_metrics(fixtures.dirty_typed_messages(_orders(spark, sf_dir)))


# --- dates ---------------------------------------------------------------------


@registered
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select("o_orderkey", *[
        dates.date_part(at, part).alias(part)
        for part in ("year", "season", "month", "week", "day", "hour")
    ])


@registered
def date_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    starts = {
        "week": dates.first_day_of_week(at),
        "month": dates.first_day_of_month(at),
        "previous_month": dates.first_day_of_previous_month(at),
        "next_month": dates.first_day_of_next_month(at),
        "previous_week": dates.first_day_of_previous_week(at),
        "next_week": dates.first_day_of_next_week(at),
        "previous_month_hour": dates.first_day_of_previous_month(at, keep_hour=True),
        "next_week_hour": dates.first_day_of_next_week(at, keep_hour=True),
        "ten_days_back": dates.plus_days(at, -10),
    }
    return table(spark, sf_dir, "events").select("event_id", *[
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name) for name, c in starts.items()
    ])


@registered
def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    millis = dates.text_to_millis(day)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        millis.alias("millis"),
        dates.millis_to_text(millis + 86_400_000, "yyyy/MM/dd HH:mm").alias("next_day"),
        dates.day_suffix(day).alias("suffix"),
    )


@registered
def order_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.datediff(F.to_date(dates.today()), day).alias("days_to_today"),
        F.datediff(F.to_date(dates.yesterday()), day).alias("days_to_yesterday"),
    )


@registered
def server_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = logs.split_log_line(_lines(spark, sf_dir))
    at = F.col("s_time")
    return split.select(
        "event_id",
        dates.server_time_millis(at).alias("millis"),
        F.date_format(dates.server_time(at), "yyyy-MM-dd HH:mm:ss").alias("at"),
    )


@registered
def running_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'yyyyMMdd') WHEN 1 THEN ''
             WHEN 2 THEN concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 00')
             WHEN 3 THEN NULL ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS given""",
    )
    return given.select(
        "o_orderkey",
        dates.is_valid_running_date(F.col("given")).alias("valid"),
        text.is_blank(F.col("given")).alias("blank"),
    )


@registered
def frequent_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of parts that three orders or more have together."""
    sets = baskets.frequent_sets(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", 3)
    return sets.select(F.array_join(F.col("items").cast("array<string>"), " ").alias("parts"),
                       F.size("items").alias("n_parts"), F.col("n_baskets").alias("n_orders"))


@registered
def part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that come along with others in a tenth of the orders or more."""
    rules = baskets.rules_between(
        table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", 3, 0.1)
    return rules.select(
        F.array_join(F.col("antecedent").cast("array<string>"), " ").alias("antecedent"),
        F.col("consequent").cast("string").alias("consequent"), "confidence")
