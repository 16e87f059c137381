"""The daily table behind manifests: swaps, crashes, appends, snapshots."""

import pytest
from pyspark.sql import functions as F

from clickweir import manifests, workspace
from clickweir.sinks import events as sinks
from clickweir.sources import events as sources

DAY = "2015-12-20"


def events(spark, *users, columns="u_ud string, en string"):
    return spark.createDataFrame([(u, "e_l") for u in users], columns)


def users(spark, table, day=DAY):
    return sorted(r.u_ud for r in sources.read_events(spark, table, day).collect())


def folders(spark, table):
    return set(workspace.list_dir(spark, f"{table}/event_date={DAY}"))


def test_a_reader_during_the_swap_keeps_its_day(spark, tmp_path):
    table = f"{tmp_path}/t"
    sinks.write_daily_events(events(spark, "a", "b"), table, DAY)
    before = sources.read_events(spark, table, DAY)
    sinks.write_daily_events(events(spark, "c"), table, DAY)
    sinks.retire_folders(spark, table, DAY)
    assert sorted(r.u_ud for r in before.collect()) == ["a", "b"]
    assert users(spark, table) == ["c"]


def test_a_crash_between_the_steps_changes_nothing(spark, tmp_path, monkeypatch):
    table = f"{tmp_path}/t"
    sinks.write_daily_events(events(spark, "a"), table, DAY)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:  # data written, manifest not
        patch.setattr(manifests, "commit", crash)
        with pytest.raises(OSError):
            sinks.write_daily_events(events(spark, "b"), table, DAY)
    assert users(spark, table) == ["a"] and len(folders(spark, table)) == 2
    broken = events(spark, "c").withColumn("u_ud", F.raise_error(F.lit("x")).cast("string"))
    with pytest.raises(Exception):  # data not written
        sinks.write_daily_events(broken, table, DAY)
    assert users(spark, table) == ["a"]
    assert sinks.retire_folders(spark, table, DAY)
    assert len(folders(spark, table)) == 1 and users(spark, table) == ["a"]
    # A staged manifest that was never renamed is not one.
    (tmp_path / "t" / "_days" / DAY / "_staged-x").write_text("{")
    sinks.write_daily_events(events(spark, "d"), table, DAY)
    assert users(spark, table) == ["d"]


def test_of_two_writers_one_wins(spark, tmp_path):
    table, days = f"{tmp_path}/t", sources.day_manifests(f"{tmp_path}/t", DAY)
    sinks.write_daily_events(events(spark, "a"), table, DAY)
    number, content = manifests.newest(spark, days)
    sinks.write_daily_events(events(spark, "b"), table, DAY)
    with pytest.raises(FileExistsError):
        manifests.commit(spark, days, number, content)
    assert users(spark, table) == ["b"]
    assert not [n for n in workspace.list_dir(spark, days) if n.startswith("_staged")]


def test_append_adds_folders_and_columns(spark, tmp_path):
    table = f"{tmp_path}/t"
    sinks.append_daily_events(events(spark, "a"), table, DAY)
    kept = folders(spark, table)
    more = events(spark, "b").withColumn("ver", F.lit("2"))
    sinks.append_daily_events(more, table, DAY)
    assert kept < folders(spark, table)
    got = sources.read_events(spark, table, DAY, ["u_ud", "ver"], "e_l").collect()
    assert sorted(map(tuple, got), key=str) == [("a", None), ("b", "2")]
    with pytest.raises(ValueError):
        sinks.append_daily_events(more.withColumn("ver", F.lit(2)), table, DAY)
    with pytest.raises(FileExistsError):
        sinks.write_daily_events(more, table, DAY, overwrite=False)


def test_a_snapshot_copies_no_rows_and_outlives_the_day(spark, tmp_path):
    table, root = f"{tmp_path}/t", f"{tmp_path}/s"
    with pytest.raises(FileNotFoundError):
        sinks.publish_snapshot(spark, table, DAY, root)
    sinks.write_daily_events(events(spark, "a"), table, DAY)
    path = sinks.publish_snapshot(spark, table, DAY, root)
    assert not list((tmp_path / "s").rglob("*.parquet")) and not workspace.is_dir(spark, path)
    for name in "bcd":
        sinks.write_daily_events(events(spark, name), table, DAY)
        sinks.retire_folders(spark, table, DAY)
    # The snapshot's folder, the one in force and the one before it.
    assert len(folders(spark, table)) == 3
    assert [r.u_ud for r in sources.read_snapshot(spark, root, DAY).collect()] == ["a"]
    with pytest.raises(FileExistsError):
        sinks.publish_snapshot(spark, table, DAY, root)


def test_days_without_rows_or_writes_are_empty(spark, tmp_path):
    table = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        sources.read_events(spark, table, DAY)
    sinks.write_daily_events(events(spark), table, DAY)
    assert users(spark, table) == []
    other = sources.read_events(spark, table, "2015-12-21", ["u_ud"], "e_l")
    assert other.isEmpty() and other.columns == ["u_ud"]
