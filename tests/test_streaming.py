"""Streaming equals batch, over several micro-batches and across restarts."""

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickweir import storage
from clickweir.operators import orders
from clickweir.plans import order_etl, order_statistics
from clickweir.sinks import console, routed
from clickweir.sources.offsets import read_ledger
from clickweir.sources.streams import StreamSource, order_stream
from clickweir.streaming import runner, state, statistics

SCHEMA = ("topic string, partition int, offset long, timestamp timestamp, key binary, "
          "value string")


def body(i):
    return (f'{{"orderType":"{["alipay", "card", "cash"][i % 3]}","orderId":"o{i % 30}",'
            f'"provinceId":{i % 5 + 1},"orderPrice":{i}.5}}')


class Topic:
    """A folder of message files, each file one micro-batch."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)
        self.source = StreamSource(format="parquet", path=self.path, max_per_trigger=1,
                                   schema=spark.createDataFrame([], SCHEMA).schema)

    def send(self, first, last, value=body):
        rows = [("etlTopic", i % 3, i, i, b"k", value(i)) for i in range(first, last)]
        frame = self.spark.createDataFrame(
            rows, "topic string, partition int, offset long, at long, key binary, value string"
        )
        frame.withColumn("timestamp", F.timestamp_seconds("at")).drop("at").coalesce(1) \
            .write.mode("append").parquet(self.path)

    def stream(self):
        return order_stream(self.spark, self.source)

    def all(self):
        return self.spark.read.schema(self.source.schema).parquet(self.path) \
            .withColumn("value", F.col("value").cast("string"))


@pytest.fixture
def topic(spark, tmp_path):
    made = Topic(spark, tmp_path / "topic")
    made.send(0, 40)
    made.send(40, 100)
    return made


def totals_of(df):
    return {r.province_id: round(r.total, 4) for r in df.collect()}


def test_rejected_orders_are_reported_per_batch(spark, tmp_path):
    topic = Topic(spark, tmp_path / "topic")
    topic.send(0, 9, lambda i: body(i) if i % 3 else "not json")
    query = runner.run_query(order_statistics.revenue_query(
        order_statistics.json_orders(topic.stream()), str(tmp_path / "totals"),
        str(tmp_path / "cp"), "update", None,
    ))
    assert query.lastProgress["observedMetrics"]["orders"].asDict() == {
        "accepted": 6, "rejected": 3
    }


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_running_revenue_survives_a_restart(spark, topic, tmp_path, mode):
    totals = str(tmp_path / "totals")

    def run():
        runner.run_query(order_statistics.revenue_query(
            order_statistics.json_orders(topic.stream()), totals, str(tmp_path / "cp"), mode, None
        ))
        batch = orders.province_revenue(order_statistics.json_orders(topic.all()))
        assert totals_of(storage.read_keyed(spark, totals)) == totals_of(batch)

    run()
    topic.send(100, 130)
    run()


def test_complete_emits_all_provinces_and_update_the_changed_ones(spark, tmp_path):
    topic = Topic(spark, tmp_path / "topic")
    topic.send(0, 10)
    topic.send(10, 12)  # provinces 1 and 2 only
    seen = {}
    for mode in ("complete", "update"):
        batches = []
        runner.run_query(runner.foreach_batch(
            statistics.running_revenue(order_statistics.json_orders(topic.stream())),
            lambda df, _, into=batches: into.append(df.count()),
            str(tmp_path / mode), mode,
        ))
        seen[mode] = batches
    assert seen == {"complete": [5, 5], "update": [5, 2]}


def test_stateful_map_equals_the_aggregate(spark, topic, tmp_path):
    parsed = order_statistics.json_orders(topic.stream()).select("province_id", "order_price")
    totals = str(tmp_path / "totals")
    runner.run_query(runner.foreach_batch(
        state.stateful_map(parsed, "province_id", state.running_sum("order_price"),
                           "total double",
                           combine=state.summed_by("province_id", "order_price")),
        statistics.upsert_totals(totals), str(tmp_path / "cp"),
    ))
    batch = orders.province_revenue(order_statistics.json_orders(topic.all()))
    assert totals_of(storage.read_keyed(spark, totals)) == totals_of(batch)


def test_combiner_leaves_one_row_per_key():
    chunk = pd.DataFrame({"k": [1, 2, 1], "v": [1.0, 2.0, 3.0]})
    assert state.summed_by("k", "v")(chunk).values.tolist() == [[1.0, 4.0], [2.0, 2.0]]
    total = state.running_sum("v")
    assert total((1,), iter([chunk, chunk]), (10.0,)) == (22.0,)


def test_window_counts_equal_batch(spark, topic, tmp_path):
    counts = str(tmp_path / "counts")
    stream = order_statistics.json_orders(topic.stream())
    runner.run_query(runner.foreach_batch(
        statistics.windowed_counts(stream), statistics.upsert_window_counts(counts),
        str(tmp_path / "cp"),
    ))
    columns = ["window_start", "province_id", "cnt"]
    batch = orders.windowed_order_count(order_statistics.json_orders(topic.all()))
    assert sorted(map(tuple, storage.read_keyed(spark, counts).select(columns).collect())) == \
        sorted(map(tuple, batch.select(columns).collect()))


def test_newest_closed_window_is_published(spark, topic, tmp_path):
    counts, published = str(tmp_path / "counts"), []
    stream = order_statistics.json_orders(topic.stream())

    def publish(top):
        published.append([(r.window_end.timestamp(), r.province_id, r.cnt, r.rank)
                          for r in top.orderBy("rank").collect()])

    runner.run_query(order_statistics.ranking_query(
        stream, counts, publish, str(tmp_path / "cp"), watermark="1 minute", interval=None
    ))
    # Windows are 15 s long and start every 10 s; the last order is at second 39, then 99.
    assert [p[0][0] for p in published] == [35.0, 95.0]
    batch = orders.windowed_order_count(order_statistics.json_orders(topic.all()))
    newest = batch.where(F.col("window_end") == F.timestamp_seconds(F.lit(95)))
    assert [(p, c) for _, p, c, _ in published[-1]] == [
        (r.province_id, r.cnt) for r in orders.top_provinces(newest).collect()
    ]
    kept = storage.read_keyed(spark, counts).agg(F.min("window_end")).first()[0]
    assert kept.timestamp() == 95.0


def test_order_etl_survives_a_restart(spark, topic, tmp_path):
    root, ledger = str(tmp_path / "routed"), str(tmp_path / "ledger")

    def run():
        runner.run_query(order_etl.order_etl_query(
            spark, topic.source, root, str(tmp_path / "cp"), ledger, None
        ))
        got = {(r.sink, r.order_id): r.value for r in routed.read_routed(spark, root).collect()}
        # The newest message of an order is the one with its last number.
        last = {}
        for r in topic.all().orderBy("offset").collect():
            i = r.offset
            sink = ["alipay", "card", "other"][i % 3]
            last[(sink, f"o{i % 30}")] = r.value
        assert got == last

    run()
    topic.send(100, 120)
    run()
    assert sorted((r.partition, r.until_offset) for r in read_ledger(spark, ledger).collect()) == [
        (0, 118), (1, 119), (2, 120)
    ]


def test_failure_reaches_the_caller_and_stops_the_query(spark, topic, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    writer = runner.foreach_batch(topic.stream(), fail, str(tmp_path / "cp"), "append")
    with pytest.raises(StreamingQueryException, match="sink is down"):
        runner.run_query(writer)
    assert not spark.streams.active


def test_body_runs_with_the_started_query(spark, topic, tmp_path):
    seen = []
    writer = runner.foreach_batch(
        topic.stream(), lambda df, i: seen.append(df.count()), str(tmp_path / "cp"), "append",
        interval=runner.ORDER_ETL_INTERVAL,
    )
    query = runner.run_query(writer, body=lambda q: q.processAllAvailable())
    assert seen == [40, 60] and not query.isActive


def test_console(spark, topic, tmp_path, capsys):
    writer = console.console_writer(topic.stream(), "append", rows=1)
    query = runner.run_query(writer.option("checkpointLocation", str(tmp_path / "cp"))
                             .trigger(availableNow=True))
    assert [p["numInputRows"] for p in query.recentProgress] == [40, 60]
    assert "Console" in query.lastProgress["sink"]["description"]
    console.show_frame(topic.all().select("offset").orderBy("offset"), 1)
    assert "|0     |" in capsys.readouterr().out
    assert len(console.batch_header(topic.all(), "yyyy-MM-dd HH:mm:ss")) == 19


def test_routing_reports_what_it_leaves_out(spark, tmp_path):
    from clickweir.streaming import order_etl

    rows = [("t", 0, i, f'{{"orderId": "{i}"}}' if i % 3 else "broken") for i in range(9)]
    batch = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    reports = []
    order_etl.store_orders(f"{tmp_path}/routed", report=lambda *r: reports.append(r))(batch, 4)
    assert reports == [(4, {"received": 9, "stored": 6, "rejected": 3})]


def test_ledger_names_idle_and_new_partitions(spark, tmp_path):
    from clickweir.sources import offsets
    from clickweir.streaming import order_etl

    ledger = f"{tmp_path}/ledger"

    def commit(*rows):
        order_etl.commit_offsets(spark.createDataFrame(
            rows, "topic string, partition int, offset long"), ledger)

    assert offsets.load_offsets(spark, ledger, "t", "latest", 4) == "latest"
    commit(("t", 0, 5), ("t", 2, 7))
    commit(("t", 2, 9))  # partition 0 is idle in this batch and keeps its place
    assert offsets.load_offsets(spark, ledger, "t") == '{"t":{"0":6,"2":10}}'
    assert offsets.load_offsets(spark, ledger, "t", partitions=4) == (
        '{"t":{"0":6,"1":-2,"2":10,"3":-2}}')
