"""Offline new-user analytics over a day of events."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from clickweir import schemas, storage
from clickweir.operators.analytics import (
    as_result_table,
    launch_dimensions,
    new_users_by_browser,
    new_users_by_browser_sql,
    new_users_by_platform,
)
from clickweir.plans.log_etl import process_day
from clickweir.session import build_session
from clickweir.sinks.jdbc import JdbcTarget, upsert_jdbc
from clickweir.sources.events import read_events, read_snapshot

RESULT_KEYS = ["day_dim", "platform_dim", "browser_dim"]


def launches(
    spark: SparkSession, table: str, process_date: str, snapshot: bool = False
) -> DataFrame:
    """The day's launch events, from the live table or from a snapshot root."""
    scan = read_snapshot if snapshot else read_events
    return scan(spark, table, process_date, schemas.LAUNCH_COLUMNS, schemas.LAUNCH)


def new_user_counts(launch_events: DataFrame, form: str = "browser") -> DataFrame:
    """Counts by platform, by browser, or by browser through SQL."""
    count = {
        "platform": new_users_by_platform,
        "browser": new_users_by_browser,
        "browser_sql": new_users_by_browser_sql,
    }[form]
    return count(launch_dimensions(launch_events))


def run_new_users(
    spark: SparkSession, table: str, process_date: str, result: str | JdbcTarget,
    snapshot: bool = False, dialect: str = "ansi",
) -> None:
    """Upsert the day's browser counts into the result: a keyed table or a relational one."""
    counts = as_result_table(new_user_counts(launches(spark, table, process_date, snapshot)))
    if isinstance(result, JdbcTarget):
        upsert_jdbc(counts, result, RESULT_KEYS, dialect)
    else:
        storage.upsert_table(counts, result, RESULT_KEYS)


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description="Count new users of a day")
    args.add_argument("process_date", type=process_day)
    args.add_argument("--table", required=True)
    args.add_argument("--result", required=True, help="a path, or with --jdbc-url a table's name")
    args.add_argument("--jdbc-url")
    args.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE")
    args.add_argument("--dialect", choices=["ansi", "mysql"], default="ansi")
    args.add_argument("--snapshot", action="store_true")
    args.add_argument("--zone", default="UTC")
    given = args.parse_args(argv)
    spark = build_session("new-users", zone=given.zone)
    result = given.result
    if given.jdbc_url:
        result = JdbcTarget(given.jdbc_url, result,
                            dict(p.split("=", 1) for p in given.jdbc_property))
    run_new_users(spark, given.table, given.process_date, result, given.snapshot, given.dialect)


if __name__ == "__main__":
    main()
