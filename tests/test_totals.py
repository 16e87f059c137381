"""Typed state with timers and a seed: equals the batch answer, across restarts."""

import datetime as dt

import pytest

from clickweir import storage
from clickweir.sources.streams import table_stream
from clickweir.streaming import runner, statistics, totals

SCHEMA = "province_id int, price double, at timestamp"
DAY = 86_400


def orders(spark, *given):
    start = dt.datetime(2024, 1, 1)
    rows = [(p, float(a), start + dt.timedelta(days=d) if d is not None else None)
            for p, a, d in given]
    return totals.period_rows(spark.createDataFrame(rows, SCHEMA), "province_id", "price", "at",
                              "day")


class Run:
    """A stream over a folder; each call takes the new rows with the same checkpoint."""

    def __init__(self, spark, path, seed=None):
        self.spark, self.path, self.seed = spark, str(path), seed

    def __call__(self, rows):
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        stream = table_stream(self.spark, f"{self.path}/in")
        with totals.rocks_db_state(self.spark):
            runner.run_query(runner.foreach_batch(
                totals.period_totals(stream, "province_id", 3, "0 seconds", self.seed),
                statistics.upsert_newest(f"{self.path}/out"), f"{self.path}/checkpoint"))
        got = storage.read_keyed(self.spark, f"{self.path}/out").collect()
        return {r.province_id: (r.total, r.recent) for r in got}


def test_periods_expire_and_the_state_survives_restarts(spark, tmp_path):
    run = Run(spark, tmp_path)
    assert run(orders(spark, (1, 10, 0), (1, 5, 1), (2, 7, 1), (3, 1, None))) == {
        1: (15.0, 15.0), 2: (7.0, 7.0)}
    # The watermark reaches day 3: what began on day 0 goes.
    assert run(orders(spark, (2, 1, 3)))[1] == (15.0, 5.0)
    last = run(orders(spark, (2, 2, 10)))
    assert last == {1: (15.0, 0.0), 2: (10.0, 2.0)}


def test_a_seed_is_read_once(spark, tmp_path):
    seed = orders(spark, (1, 100, 0), (1, 50, 1), (4, 9, 1))
    run = Run(spark, tmp_path, seed)
    assert run(orders(spark, (1, 1, 1))) == {1: (151.0, 151.0)}
    got = run(orders(spark, (4, 1, 2)))
    assert got == {1: (151.0, 151.0), 4: (10.0, 10.0)}


def test_rows_are_summed_before_the_shuffle(spark):
    given = orders(spark, *[(1, 1, 0)] * 500, (2, 1, 0)).coalesce(1)
    assert sorted((r.province_id, r.amount) for r in totals._summed(
        given, "province_id").collect()) == [(1, 500.0), (2, 1.0)]


def test_the_setting_is_given_back(spark):
    before = spark.conf.get(totals._PROVIDER)
    with pytest.raises(KeyError), totals.rocks_db_state(spark):
        raise KeyError
    assert spark.conf.get(totals._PROVIDER) == before
