import pytest

from clickweir.operators import orders
from clickweir.plans import order_etl, order_statistics
from clickweir.sources.streams import StreamSource


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def triples(df):
    return [(r.order_id, r.province_id, r.order_price) for r in df.collect()]


def test_json_orders(spark):
    parsed = orders.parse_sale_order(messages(
        spark, '{"orderId":"a","provinceId":3,"orderPrice":1.5}',
        '{"orderId":"b","provinceId":3,"orderPrice":2.5,"extra":{"x":1}}',
        '{"orderId":"c","orderPrice":2.5}', '{"orderId":"d","provinceId":4}',
        "not json", '{"orderId":"e","provinceId":"x","orderPrice":1}', None,
    ))
    assert triples(orders.valid_orders(parsed)) == [("a", 3, 1.5), ("b", 3, 2.5)]
    assert orders.order_metrics(parsed).first().asDict() == {
        "loaded": 7, "accepted": 2, "rejected": 5
    }


def test_csv_orders(spark):
    given = messages(
        spark, "a,3,1.5", " b,4,2 ", "c,3", "d,3,1,x", "e,3,", "f,3,1,,", "", "   ", None,
        "g,p,1", "h, 3,1", "i,3,x", ",5,1", "j,99999999999,1",
    )
    assert triples(order_statistics.csv_orders(given)) == [
        ("a", 3, 1.5), ("b", 4, 2.0), ("f", 3, 1.0), ("", 5, 1.0)
    ]
    kept = [r.value for r in orders.filter_valid_csv(given).collect()]
    assert kept == ["a,3,1.5", " b,4,2 ", "f,3,1,,", "g,p,1", "h, 3,1", "i,3,x", ",5,1",
                    "j,99999999999,1"]


def test_top_provinces_break_ties_by_id(spark):
    counts = spark.createDataFrame([(p, 5) for p in range(20, 0, -1)], "province_id int, cnt long")
    assert [r.province_id for r in orders.top_provinces(counts).collect()] == list(range(1, 11))


def test_top_provinces_as_sql(spark):
    frame = spark.createDataFrame([(1,), (2,), (2,), (3,)], "province_id int")
    assert [tuple(r) for r in orders.top_provinces_sql(frame, 2).collect()] == [(2, 2), (1, 1)]


def test_windows_overlap(spark):
    frame = spark.sql("SELECT 1 AS province_id, timestamp_seconds(12) AS ts "
                      "UNION ALL SELECT 1, timestamp_seconds(17)")
    rows = orders.windowed_order_count(frame).orderBy("window_start").collect()
    starts = [(r.window_start.timestamp() % 60, r.cnt) for r in rows]
    assert [cnt for _, cnt in starts] == [1, 2]
    assert orders.windowed(frame).count() == 3


def test_json_field(spark):
    row = orders.with_json_field(messages(spark, '{"orderType":"card","n":{"a":1}}'),
                                 "orderType", "order_type").first()
    assert (row.order_type, row.value) == ("card", '{"orderType":"card","n":{"a":1}}')


def test_kafka_options():
    source = StreamSource(topic="t", brokers="h:1", starting_offsets='{"t":{"0":5}}',
                          max_per_trigger=9000, options={"failOnDataLoss": "false"})
    assert source.reader_options() == {
        "failOnDataLoss": "false", "kafka.bootstrap.servers": "h:1", "subscribe": "t",
        "startingOffsets": '{"t":{"0":5}}', "maxOffsetsPerTrigger": "9000",
    }
    assert StreamSource(topic="t", brokers="h:1").reader_options()["startingOffsets"] == "latest"
    assert StreamSource(format="parquet", max_per_trigger=2).reader_options() == {
        "maxFilesPerTrigger": "2"
    }
    with pytest.raises(ValueError):
        StreamSource(topic="t").reader_options()


def test_order_etl_starts_from_the_ledger(spark, tmp_path, monkeypatch):
    from clickweir import storage
    from clickweir.schemas import OFFSET_LEDGER

    ledger = str(tmp_path / "ledger")
    storage.upsert_table(spark.createDataFrame([("etlTopic", 0, 42)], OFFSET_LEDGER), ledger,
                         ["topic", "partition"])
    asked = []

    def stop(spark, source):
        asked.append(source.reader_options()["startingOffsets"])
        raise InterruptedError

    monkeypatch.setattr(order_etl, "order_stream", stop)
    source = StreamSource(topic="etlTopic", brokers="h:1")
    for saved in (ledger, str(tmp_path / "none")):
        with pytest.raises(InterruptedError):
            order_etl.order_etl_query(spark, source, "root", "checkpoint", saved)
    assert asked == ['{"etlTopic":{"0":42}}', "latest"]
