"""Programs that print or hand over their results."""

import pytest
from pyspark.sql import functions as F

from clickweir.operators import orders
from clickweir.plans import csv_statistics, new_users, order_statistics
from clickweir.sinks import events as sinks
from clickweir.sources.streams import table_stream

DAY = "2015-12-20"


def send(spark, path, *lines):
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1) \
        .write.mode("append").parquet(path)


@pytest.mark.parametrize("form", csv_statistics.FORMS)
def test_csv_revenue_over_a_restart(spark, tmp_path, form):
    path, emitted = f"{tmp_path}/in", []

    def publish(batch, batch_id):
        emitted.append({r.province_id: r.total for r in batch.collect()})

    for lines in (["1,1,10.5", "2,2,3", "bad", "3,1,"], ["4,1,1.5"], ["no order"]):
        send(spark, path, *lines)
        csv_statistics.runner.run_query(csv_statistics.revenue_query(
            table_stream(spark, path), form, f"{tmp_path}/cp", publish, None))
    whole = {1: 12.0, 2: 3.0}
    changed = [{1: 10.5, 2: 3.0}, {1: 12.0}]
    assert emitted == ([changed[0], whole, whole] if form == "all" else changed)
    batch = orders.province_revenue(order_statistics.csv_orders(spark.read.parquet(path)))
    assert {r.province_id: r.total for r in batch.collect()} == whole


def test_a_printed_batch_has_its_time(spark, capsys):
    rows = spark.createDataFrame([(1, 2.0), (2, 9.0)], "province_id int, total double")
    csv_statistics.print_batch(rows, 7, rows=1)
    printed = capsys.readouterr().out
    assert printed.startswith("Time: 20") and "batch 7" in printed
    assert "|2          |9.0  |" in printed
    with pytest.raises(ValueError):
        csv_statistics.revenue_query(rows, "other", "x")


def test_new_users_go_to_a_relational_table(spark, tmp_path, monkeypatch):
    given = spark.createDataFrame(
        [("a", "1450569601.351", "web", "1", "IE", "9", "e_l")],
        "u_ud string, s_time string, pl string, ver string, browser string, browser_v string, "
        "en string")
    sinks.write_daily_events(given, f"{tmp_path}/t", DAY)
    calls = []
    monkeypatch.setattr(new_users, "upsert_jdbc", lambda df, *rest: calls.append(
        (df.columns, df.select(F.sum("cnt")).first()[0], *rest)))
    monkeypatch.setattr(new_users, "build_session", lambda *_, **__: spark)
    new_users.main([DAY, "--table", f"{tmp_path}/t", "--result", "new_users", "--jdbc-url",
                    "jdbc:x", "--jdbc-property", "user=u", "--dialect", "mysql"])
    target = new_users.JdbcTarget("jdbc:x", "new_users", {"user": "u"})
    [(columns, counted, *rest)] = calls
    assert columns == [*new_users.RESULT_KEYS, "cnt"] and counted >= 1
    assert rest == [target, new_users.RESULT_KEYS, "mysql"]


@pytest.mark.parametrize("day", ["2015-13-01", "20151220x", "", "yesterday"])
def test_a_wrong_day_is_refused(day, monkeypatch):
    monkeypatch.setattr(new_users, "build_session", lambda *_, **__: pytest.fail("started"))
    with pytest.raises(SystemExit):
        new_users.main([day, "--table", "t", "--result", "r"])
