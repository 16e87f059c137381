import pytest
from conftest import physical_plan
from pyspark.sql import functions as F

from clickweir import schemas, storage, workspace
from clickweir.operators import keyed, logs, orders, shaping
from clickweir.plans import log_etl, new_users
from clickweir.sinks import events as event_sinks
from clickweir.sinks import jdbc, routed
from clickweir.sources import events as event_sources
from clickweir.sources import logs as log_sources
from clickweir.sources import offsets
from clickweir.streaming import order_etl

DAY = "2015-12-20"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_latest_by_key_combines_before_the_shuffle(spark):
    frame = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "x"), ("b", 5, "y"), ("a", 3, None)], "k string, o int, v string"
    )
    newest = keyed.latest_by_key(frame, ["k"], ["o"])
    assert rows(newest, "k", "o", "v") == [("a", 3, None), ("b", 5, "y")]
    plan = physical_plan(newest)
    assert "partial_max_by" in plan and plan.count("Exchange") == 1


def test_merge_colliding_rows(spark):
    given = [
        "1.1.1.1^A10.5^Ah^A/x?en=e_l&u_ud=u&pl=a&z=1&y=1",
        "2.2.2.2^A10.5^Ah^A/x?en=e_l&u_ud=u&ver=2&z=2",
        "3.3.3.3^A10.6^Ah^A/x?en=e_l&u_ud=u",
    ]
    frame = spark.createDataFrame(list(enumerate(given)), "at int, value string")
    events = logs.with_row_key(log_etl.parse_lines(frame))
    merged = keyed.merge_colliding_rows(events, "at")
    got = {r.ip: (r.pl, r.ver, r.attrs) for r in merged.collect()}
    assert got == {"2.2.2.2": ("a", "2", {"z": "2", "y": "1"}), "3.3.3.3": (None, None, {})}


def test_upsert_table(spark, root):
    schema = "k int, v string"
    assert storage.read_keyed(spark, f"{root}/t") is None
    first = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    second = spark.createDataFrame([(2, "c"), (3, "d")], schema)
    storage.upsert_table(first, f"{root}/t", ["k"])
    for _ in range(3):  # repeating an upsert changes nothing
        storage.upsert_table(second, f"{root}/t", ["k"])
        assert rows(storage.read_keyed(spark, f"{root}/t"), "k", "v") == [
            (1, "a"), (2, "c"), (3, "d")
        ]
    assert storage.generations(spark, f"{root}/t") == [3, 4]
    storage.upsert_table(first.limit(0), f"{root}/t", ["k"], retain=F.col("k") > 2)
    assert rows(storage.read_keyed(spark, f"{root}/t"), "k", "v") == [(3, "d")]


def test_unfinished_generation_is_ignored(spark, root, tmp_path):
    frame = spark.createDataFrame([(1, "a")], "k int, v string")
    storage.upsert_table(frame, f"{root}/t", ["k"])
    (tmp_path / "t" / "gen=2").mkdir()
    (tmp_path / "t" / "gen=2" / "part-0.parquet").write_bytes(b"half written")
    assert rows(storage.read_keyed(spark, f"{root}/t"), "k", "v") == [(1, "a")]
    storage.upsert_table(frame.withColumn("v", F.lit("b")), f"{root}/t", ["k"])
    assert rows(storage.read_keyed(spark, f"{root}/t"), "k", "v") == [(1, "b")]


class Session:
    """The two session members that choose the shared folder."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = settings


def test_shared_dir_is_the_configured_one():
    configured = Session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://shared/work/"})
    assert workspace.shared_dir(configured) == "hdfs://shared/work"
    assert "clickweir-" in workspace.shared_dir(Session("local[2]"))


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        workspace.shared_dir(Session("spark://host:7077"))


def wide(spark, *lines):
    frame = spark.createDataFrame([(v,) for v in lines], "value string")
    return logs.with_row_key(log_etl.parse_lines(frame)).drop("client_ip")


def test_daily_events(spark, root):
    one = wide(spark, "i^A1.5^Ah^A/x?en=e_l&u_ud=a", "i^A1.5^Ah^A/x?en=e_pv&u_ud=a")
    two = wide(spark, "i^A2.5^Ah^A/x?en=e_l&u_ud=b")
    table = f"{root}/{schemas.EVENT_TABLE}"
    for _ in range(2):
        event_sinks.write_daily_events(one, table, DAY)
    event_sinks.write_daily_events(two, table, "2015-12-21")
    assert rows(event_sources.read_events(spark, table, DAY), "u_ud", "en") == [
        ("a", "e_l"), ("a", "e_pv")
    ]
    with pytest.raises(FileExistsError):
        event_sinks.write_daily_events(two, table, DAY, overwrite=False)
    with pytest.raises(Exception):
        broken = two.withColumn("en", F.raise_error(F.lit("lost")).cast("string"))
        event_sinks.write_daily_events(broken, table, DAY)
    assert event_sources.read_events(spark, table, DAY).count() == 2
    event_sinks.write_daily_events(two.limit(0), table, DAY)
    assert event_sources.read_events(spark, table, DAY).isEmpty()
    assert event_sources.read_events(spark, table, "2015-12-21").count() == 1


def test_scan_is_pruned_and_pushed_down(spark, root):
    table = f"{root}/events"
    event_sinks.write_daily_events(wide(spark, "i^A1.5^Ah^A/x?en=e_l&u_ud=a"), table, DAY)
    plan = physical_plan(new_users.launches(spark, table, DAY))
    scan = next(part for part in plan.splitlines() if "FileScan" in part)
    assert "EqualTo(en,e_l)" in scan
    assert "event_date" in scan.split("PartitionFilters")[1]
    read = scan.split("ReadSchema: ")[1]
    assert read.count(":") == 7 and "attrs" not in read


def test_snapshot_is_immutable(spark, root):
    table, snapshots = f"{root}/events", f"{root}/snapshots"
    event_sinks.write_daily_events(wide(spark, "i^A1.5^Ah^A/x?en=e_l&u_ud=a"), table, DAY)
    path = event_sinks.publish_snapshot(spark, table, DAY, snapshots)
    assert path.endswith("snapshot_event_logs20151220")
    event_sinks.write_daily_events(wide(spark, "i^A1.5^Ah^A/x?en=e_l&u_ud=b"), table, DAY)
    assert rows(event_sources.read_snapshot(spark, snapshots, DAY, ["u_ud"], "e_l"), "u_ud") == [
        ("a",)
    ]
    with pytest.raises(FileExistsError):
        event_sinks.publish_snapshot(spark, table, DAY, snapshots)
    with pytest.raises(ValueError):
        event_sources.day_table_name("2015-13-01")


def test_sorted_cells(spark, root):
    cells = logs.to_cells(wide(spark, *[
        f"i^A{i % 7}.5^Ah^A/x?en=e_l&u_ud=u{i}&p{i % 5}=1" for i in range(40)
    ]))
    event_sinks.write_sorted_cells(cells, f"{root}/cells")
    files = spark.read.parquet(f"{root}/cells").withColumn("f", F.input_file_name())
    spans = files.groupBy("f").agg(
        F.min(F.struct("row_key", "column")).alias("a"), F.max(F.struct("row_key", "column")).alias("b")
    ).orderBy("a").collect()
    assert files.count() == cells.count()
    assert all(left.b <= right.a for left, right in zip(spans, spans[1:], strict=False))
    for span in spans:
        inside = [tuple(r)[:2] for r in spark.read.parquet(span.f).collect()]
        assert inside == sorted(inside)


def test_log_etl_is_repeatable(spark, root):
    lines = ["10.0.0.1^A1450569601.351^Ah^A/x?en=e_l&u_ud=u&pl=a",
             "10.0.0.1^A1450569601.351^Ah^A/x?en=e_l&u_ud=u&pl=a",  # exact copy
             "bad^Aline", "9.9.9.9^A1450569601.9^Ah^A/x?en=e_pv&b_iev=MSIE%209.0"]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(
        f"{root}/logs/{DAY}"
    )
    ranges = spark.createDataFrame([(167772160, 167772170, "北京市海淀区", "x")], schemas.IP_RANGES)
    ranges.write.parquet(f"{root}/ip")
    ranges = log_sources.read_ip_ranges(spark, f"{root}/ip")
    results = []
    for run in range(2):
        counted = log_etl.run_log_etl(spark, f"{root}/logs", DAY, f"{root}/events", ranges,
                                      f"{root}/cells{run}", f"{root}/snapshots{run}")
        assert counted == {"loaded": 4, "rejected": 1, "kept": 3}
        day = event_sources.read_events(spark, f"{root}/events", DAY)
        results.append(rows(day, "row_key", "en", "province", "city", "browser"))
    assert results[0] == results[1]
    assert [r[1:] for r in results[0]] == [
        ("e_l", "北京市", "海淀区", None), ("e_pv", "unknown", "unknown", "IE")
    ]
    new_users.run_new_users(spark, f"{root}/snapshots0", DAY, f"{root}/result", snapshot=True)
    new_users.run_new_users(spark, f"{root}/events", DAY, f"{root}/result")
    assert rows(storage.read_keyed(spark, f"{root}/result"), *new_users.RESULT_KEYS, "cnt") == [
        (20, "a:unknown", "unknown:unknown", 1)
    ]


def test_csv_ip_ranges(spark, root, tmp_path):
    (tmp_path / "ip.csv").write_text("begin_ip_num,end_ip_num,country,area\n1,2,美国,x\n")
    assert log_sources.read_ip_ranges(spark, f"{root}/ip.csv", "csv").first().country == "美国"


def test_views_and_frames(spark, capsys):
    frame = log_sources.create_frame(
        spark, [("u", 1, "w:1", "IE:9")], schemas.DAY_PLATFORM_BROWSER
    )
    name = event_sinks.register_view(frame, "dims")
    event_sinks.register_view(frame, "dims")
    assert spark.newSession().sql(f"SELECT * FROM {name}").first().uuid == "u"
    frame.printSchema()
    assert "platformDimension: string" in capsys.readouterr().out


def test_shaping(spark):
    frame = spark.range(100).repartition(4).cache()
    assert shaping.shrink_partitions(frame).rdd.getNumPartitions() == 1
    assert shaping.shrink_partitions(frame, max_rows=99).rdd.getNumPartitions() == 4
    assert shaping.preview(frame, 3).count() == 3
    frame.unpersist()
    with shaping.cached(frame) as kept:
        with shaping.cached(frame):
            pass
        assert kept.storageLevel.useDisk
    assert not frame.storageLevel.useDisk
    assert workspace.materialized(frame, "frame").count() == 100
    assert shaping.spread_small_input(spark.range(9).coalesce(1)).rdd.getNumPartitions() == 4


MESSAGES = "topic string, partition int, offset long, timestamp timestamp, key string, value string"


def message(spark, *bodies, start=0):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i long, value string") \
        .selectExpr("'t' AS topic", "CAST(i % 2 AS INT) AS partition", f"i + {start} AS offset",
                    f"timestamp_seconds(1000 + i + {start}) AS timestamp", "'k' AS key", "value")


def test_routing_rule(spark):
    frame = spark.createDataFrame(
        [("alipay",), ("weixin",), ("card",), ("Alipay",), ("",), (None,)], "order_type string"
    )
    assert [r.sink for r in orders.route_by_type(frame).collect()] == [
        "alipay", "weixin", "card", "other", "other", "other"
    ]


def test_routed_store_is_idempotent(spark, root):
    first = message(
        spark, '{"orderType":"alipay","orderId":"1","v":1}', '{"orderType":"card","orderId":"2"}',
        '{"orderId":"3"}', "not json", '{"orderType":"alipay"}',
        '{"orderType":"alipay","orderId":"1","v":2}',
    )
    again = message(spark, '{"orderType":"alipay","orderId":"1","v":3}', start=10)
    store = order_etl.store_orders(f"{root}/routed", f"{root}/ledger")
    for batch, batch_id in ((first, 0), (first, 0), (again, 1), (again, 1)):
        store(batch, batch_id)
    expected = [("alipay", "1", '{"orderType":"alipay","orderId":"1","v":3}'),
                ("card", "2", '{"orderType":"card","orderId":"2"}'),
                ("other", "3", '{"orderId":"3"}')]
    assert rows(routed.read_routed(spark, f"{root}/routed"), "sink", "order_id", "value") == expected
    assert rows(routed.read_routed(spark, f"{root}/routed", "card"), "order_id") == [("2",)]
    assert rows(offsets.read_ledger(spark, f"{root}/ledger"), "topic", "partition",
                "until_offset") == [("t", 0, 11), ("t", 1, 6)]
    routed.compact_routed(spark, f"{root}/routed", f"{root}/compacted")
    compacted = routed.read_routed(spark, f"{root}/compacted")
    assert rows(compacted, "sink", "order_id", "value") == expected
    assert rows(spark.read.parquet(f"{root}/compacted").distinct(), "batch_id") == [(1,)] * 3
    store_on = order_etl.store_orders(f"{root}/compacted")
    store_on(message(spark, '{"orderType":"card","orderId":"2","v":9}', start=20), 2)
    assert rows(routed.read_routed(spark, f"{root}/compacted", "card"), "value") == [
        ('{"orderType":"card","orderId":"2","v":9}',)
    ]


def test_saved_offsets(spark, root):
    ledger = f"{root}/ledger"
    assert offsets.load_offsets(spark, ledger, "my_topic", "earliest") == "earliest"
    storage.upsert_table(
        spark.createDataFrame([("my_topic", 0, 5), ("my_topic", 10, 7), ("other", 0, 1)],
                              schemas.OFFSET_LEDGER), ledger, order_etl.LEDGER_KEYS)
    assert offsets.load_offsets(spark, ledger, "my_topic") == '{"my_topic":{"0":5,"10":7}}'


def test_jdbc_statements():
    columns, keys = ["day_dim", "platform_dim", "cnt"], ["day_dim", "platform_dim"]
    assert jdbc.upsert_statement("r", "s", columns, keys, "mysql") == (
        "INSERT INTO r (day_dim, platform_dim, cnt) SELECT day_dim, platform_dim, cnt FROM s "
        "ON DUPLICATE KEY UPDATE cnt = VALUES(cnt)"
    )
    assert jdbc.upsert_statement("r", "s", columns, keys) == (
        "MERGE INTO r t USING s s ON t.day_dim = s.day_dim AND t.platform_dim = s.platform_dim "
        "WHEN MATCHED THEN UPDATE SET cnt = s.cnt WHEN NOT MATCHED THEN INSERT "
        "(day_dim, platform_dim, cnt) VALUES (s.day_dim, s.platform_dim, s.cnt)"
    )
    target = jdbc.JdbcTarget("jdbc:x", "r", {"user": "u"})
    assert target.writer_properties() == {"batchsize": "500", "user": "u"}


def test_pieces_are_bounded_by_rows(spark):
    one = spark.range(1000).coalesce(1)
    assert shaping.spread_small_input(one, piece_rows=100).rdd.getNumPartitions() == 10
    wide = spark.range(0, 1000, 1, 12)
    assert shaping.spread_small_input(wide, piece_rows=100).rdd.getNumPartitions() == 12


def test_a_large_micro_batch_comes_in_several_files(spark, tmp_path, monkeypatch):
    from clickweir.parity import queries

    spark.range(800).selectExpr(
        "id AS o_orderkey", "id % 90 AS o_custkey", "CAST(id AS DOUBLE) AS o_totalprice",
        "'1-URGENT' AS o_orderpriority", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS o_orderdate",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(shaping, "PIECE_ROWS", 20)
    files, batches = [], []
    write, read = queries.routed.write_runs, queries.table_stream

    def spied(orders, root, batch_id, **options):
        batches.append(batch_id)
        return write(orders, root, batch_id, **options)

    def stream(spark, path, max_files):
        files.append((max_files, len(spark.read.parquet(path).inputFiles())))
        return read(spark, path, max_files=max_files)

    monkeypatch.setattr(queries.routed, "write_runs", spied)
    monkeypatch.setattr(queries, "table_stream", stream)
    found = queries.QUERIES["routed_compacted"](spark, str(tmp_path)).collect()
    assert batches == [*range(8)] and files == [(5, 20), (5, 40)]
    newest = {f"C{k % 90}": k for k in sorted(range(800), key=lambda k: (k % 3, k))}
    assert {r["order_id"]: r["offset"] for r in found} == newest
