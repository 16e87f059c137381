"""Sessions, as-of merges, order states, activity and roll-ups."""

import datetime as dt

import pytest

from clickweir import workspace
from clickweir.operators import activity, analytics, asof, lifecycle, sessions
from clickweir.sinks import batches
from clickweir.sources.streams import table_stream
from clickweir.streaming import runner

NOON = dt.datetime(2024, 3, 1, 12)


def at(minutes=0, seconds=0):
    return NOON + dt.timedelta(minutes=minutes, seconds=seconds)


def test_sessions_end_at_a_gap(spark):
    rows = [("a", at(0), True), ("a", at(29, 59), False), ("a", at(59, 58), True),
            ("a", at(90), True), ("b", at(3), False), ("b", at(33), True),
            ("b", at(63, 1), True), (None, at(1), True),
            ("c", None, True)]
    visits = spark.createDataFrame(rows, "user string, ts timestamp, page_view boolean")
    found = {tuple(r) for r in sessions.session_metrics(visits.repartition(4)).collect()}
    assert found == {("a", at(0), 3598.0, 2, 3), ("a", at(90), 0.0, 1, 1),
                     ("b", at(3), 1800.0, 1, 2), ("b", at(63, 1), 0.0, 1, 1)}


def _emitted(spark, tmp_path, schema, parts, build):
    """Rows emitted after each part, and the rows of state left, over one resumed stream."""
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    seen, left = [], []
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        query = runner.run_query(runner.foreach_batch(
            build(table_stream(spark, source)), batches.store_batches(out), f"{tmp_path}/check",
            "append"))
        rows = batches.read_batches(spark, out).count() if workspace.exists(spark, out) else 0
        seen.append(rows)
        left.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    return seen, left, out


def test_open_sessions_merge_over_batches_and_close_with_the_watermark(spark, tmp_path):
    parts = [[("a", at(0), True), ("b", at(5), True)], [("a", at(20), True), ("a", at(50), False)],
             [("a", at(35), True)], [("z", at(400), False)], [("z", at(800), False)]]
    seen, left, out = _emitted(
        spark, tmp_path, "user string, ts timestamp, page_view boolean", parts,
        lambda s: sessions.session_metrics(s, "30 minutes", "60 minutes"))
    assert seen[0] == 0 and seen[-1] == 3 and left[-1] < max(left)
    rows = {tuple(r)[:5] for r in batches.read_batches(spark, out).collect()}
    assert ("a", at(0), 3000.0, 3, 4) in rows and ("b", at(5), 0.0, 1, 1) in rows


def test_orders_never_paid_come_out_once_and_leave_the_state(spark, tmp_path):
    schema = "side string, order_id long, outcome string, at timestamp"
    parts = [[("o", 1, None, at(0)), ("o", 2, None, at(1)), ("r", 1, "paid", at(9))],
             [("r", 1, "refunded", at(30)), ("r", 2, "paid", at(90)), ("o", 3, None, at(100))],
             [("o", 9, None, at(900)), ("r", 8, "paid", at(900))]]

    def build(stream):
        created = stream.where("side = 'o'").selectExpr("order_id", "at AS created_at", "1 AS amount")
        outcomes = stream.where("side = 'r'").selectExpr("order_id", "outcome", "at AS outcome_at")
        return lifecycle.with_outcomes(created, outcomes, "60 MINUTES", "10 MINUTES")

    seen, left, out = _emitted(spark, tmp_path, schema, parts, build)
    # Order 2 is given up as soon as the watermark is past its hour.
    assert seen == [1, 3, 4] and left[-1] < max(left)
    joined = batches.read_batches(spark, out).drop("batch_id")
    assert sorted((r["order_id"], r["outcome"]) for r in joined.collect() if r["outcome"]) == [
        (1, "paid"), (1, "refunded")]
    states = {tuple(r) for r in lifecycle.order_states(joined).collect()}
    assert states == {(1, 1, "refunded", 540), (2, 1, "unpaid", None), (3, 1, "unpaid", None)}


def test_order_states_bear_repeats_and_refunds_before_payment(spark):
    rows = [(1, "paid", at(5)), (1, "paid", at(5)), (2, "refunded", at(1)), (2, "paid", at(5)),
            (3, "refunded", at(5)), (4, None, None)]
    joined = spark.createDataFrame(
        [(i, at(0), 10, o, t) for i, o, t in rows],
        "order_id long, created_at timestamp, amount int, outcome string, outcome_at timestamp")
    states = lifecycle.order_states(joined)
    assert sorted(tuple(r) for r in states.collect()) == [
        (1, 10, "paid", 300), (2, 10, "paid", 300), (3, 10, "unpaid", None),
        (4, 10, "unpaid", None)]
    assert {tuple(r) for r in lifecycle.state_totals(states).collect()} == {
        ("paid", 2, 20), ("unpaid", 2, 20), ("total", 4, 40)}


@pytest.mark.parametrize("chunk_seconds", [60, 3600, 86_400])
def test_latest_before(spark, chunk_seconds):
    values = [(1, at(0), 1, "a"), (1, at(10), 2, "b"), (1, at(10), 3, "c"), (1, at(300), 4, "d"),
              (2, at(50), 5, "e"), (None, at(0), 6, "x"), (1, None, 7, "y"), (1, at(20), 8, None)]
    asked = [(1, at(-1), 10), (1, at(0), 11), (1, at(9), 12), (1, at(10), 13), (1, at(250), 14),
             (1, at(300), 15), (1, at(9000), 16), (2, at(49), 17), (3, at(60), 18),
             (None, at(60), 19), (1, None, 20)]
    found = asof.latest_before(
        spark.createDataFrame(asked, "key long, at timestamp, kind int"),
        spark.createDataFrame(values, "key long, at timestamp, tie long, value string"),
        chunk_seconds)
    assert found.columns == ["key", "at", "kind", "value"]
    assert {r["kind"]: r["value"] for r in found.collect()} == {
        10: None, 11: "a", 12: "a", 13: "c", 14: None, 15: "d", 16: "d", 17: None, 18: None,
        19: None, 20: None}


def test_a_hot_user_is_dealt_by_time(spark):
    from conftest import physical_plan

    values = spark.createDataFrame([], "key long, at timestamp, tie long, value string")
    plan = physical_plan(asof.latest_before(values.drop("tie", "value"), values))
    assert "hashpartitioning(key" in plan and "chunk" in plan


def test_activity_adds_days_and_replaces_them(spark, tmp_path):
    path = f"{tmp_path}/activity"
    day = [dt.date(2024, 1, k) for k in range(1, 32)]

    def record(rows):
        activity.record(spark.createDataFrame(rows, "user string, day date, number long"), path)

    record([(f"u{k}", day[0], 1) for k in range(100)] + [(None, day[0], 1), ("u1", None, 1)])
    record([(f"u{k}", day[7], 1) for k in range(50, 130)] * 3 + [("again", day[6], 1)])
    record([("again", day[6], 1), ("u3", day[6], 1)])
    numbers = [r["number"] for r in activity.dictionary(spark, path).collect()]
    assert sorted(numbers) == list(range(1, 132))
    found = {(r["period"], r["start"]): (r["active_users"], r["total_users"])
             for r in activity.activity(activity.daily_states(spark, path)).collect()}
    assert found == {
        ("day", day[0]): (100, 100), ("day", day[6]): (2, 101), ("day", day[7]): (80, 131),
        ("week", day[0]): (101, 101), ("week", day[7]): (80, 131), ("month", day[0]): (131, 131)}


def test_many_users_need_several_bitmaps_and_the_sketch_is_close(spark, tmp_path):
    visits = spark.range(90_000).selectExpr(
        "concat('u', id) AS user", "date_add(DATE'2024-01-01', CAST(id % 3 AS INT)) AS day")
    activity.record(visits, f"{tmp_path}/a")
    states = activity.daily_states(spark, f"{tmp_path}/a")
    assert states.where("bucket > 0").select("bucket").distinct().count() == 3
    for row in activity.activity(states).collect():
        assert row["active_users"] == (30_000 if row["period"] == "day" else 90_000)
        assert abs(row["estimate"] / row["active_users"] - 1) < 0.05


def test_totals_are_told_from_nulls_and_from_the_label(spark):
    rows = [("a", 1, "all", None), ("b", 1, "all", "x"), ("c", 1, None, None)]
    dimensions = spark.createDataFrame(
        rows, "uuid string, day int, platformDimension string, browserDimension string")
    found = {(r[1], r[2], r[3]): r[4] for r in analytics.new_users_rollup(dimensions).collect()}
    assert found == {("all", None, 0): 1, ("all", "x", 0): 1, (None, None, 0): 1,
                     ("all", "all", 1): 2, (None, "all", 1): 1, ("all", None, 2): 2,
                     ("all", "x", 2): 1, ("all", "all", 3): 3}
