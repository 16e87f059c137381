"""Offline log ETL: raw lines of a day to the event table, cells and a snapshot."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir import workspace
from clickweir.operators.enrich import enrich_ip, enrich_user_agent
from clickweir.operators.keyed import merge_colliding_rows
from clickweir.operators.logs import (
    filter_known_events,
    is_log_line,
    parse_event,
    project_event,
    split_log_line,
    to_cells,
    with_row_key,
)
from clickweir.operators.shaping import with_metrics
from clickweir.schemas import EVENT_COLUMNS
from clickweir.session import build_session
from clickweir.sinks.events import (
    publish_snapshot,
    retire_folders,
    write_daily_events,
    write_sorted_cells,
)
from clickweir.sources.events import read_events
from clickweir.sources.logs import read_access_logs, read_ip_ranges


def parse_lines(lines: DataFrame) -> DataFrame:
    """Log lines to wide rows of known events, before any enrichment."""
    return project_event(filter_known_events(parse_event(split_log_line(lines))))


def enrich_events(events: DataFrame, ip_ranges: DataFrame) -> DataFrame:
    return with_row_key(enrich_user_agent(enrich_ip(events, ip_ranges)))


def wide_events(lines: DataFrame, ip_ranges: DataFrame) -> DataFrame:
    """Log lines to enriched wide events with their row key, in one map-side plan.

    Columns of ``lines`` beyond the line itself are carried along.
    """
    carried = [c for c in lines.columns if c != "value"]
    events = enrich_events(parse_lines(lines), ip_ranges)
    return events.select("row_key", *EVENT_COLUMNS, "attrs", *carried)


def run_log_etl(
    spark: SparkSession,
    logs_root: str,
    process_date: str,
    table: str,
    ip_ranges: DataFrame,
    cells_path: str | None = None,
    snapshot_root: str | None = None,
) -> dict[str, int]:
    """Load one day; running it again for the same day gives the same table.

    Returns the number of lines loaded, of malformed lines and of events kept, counted on
    the way; what is neither had no known event. Staged rows are deleted at the end.

    Lines are parsed once, into a staging folder, because finding colliding row
    keys reads the events again: there it reads a single column.
    """
    staged = workspace.new_dir(spark, f"etl-{process_date}")
    lines, loaded = with_metrics(
        read_access_logs(spark, logs_root, process_date), "loaded",
        rejected=F.count_if(~F.coalesce(is_log_line(F.col("value")), F.lit(False))))
    parsed, kept = with_metrics(wide_events(lines, ip_ranges), "kept")
    parsed.write.parquet(staged)
    events = merge_colliding_rows(spark.read.parquet(staged), "ingest_order")
    write_daily_events(events, table, process_date)
    retire_folders(spark, table, process_date)
    if cells_path:
        day = read_events(spark, table, process_date).drop("event_date")
        write_sorted_cells(to_cells(day), cells_path)
    if snapshot_root:
        publish_snapshot(spark, table, process_date, snapshot_root)
    workspace.delete(spark, staged)
    return {"loaded": loaded.get["rows"], "rejected": loaded.get["rejected"],
            "kept": kept.get["rows"]}


def process_day(value: str) -> str:
    """A day as ``yyyy-MM-dd``; anything else would name a partition no date can be read from."""
    return dt.date.fromisoformat(value).isoformat()


def main(argv: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description="Load one day of access logs")
    args.add_argument("process_date", type=process_day)
    args.add_argument("--logs", required=True)
    args.add_argument("--table", required=True)
    args.add_argument("--ip-ranges", required=True)
    args.add_argument("--ip-format", default="parquet")
    args.add_argument("--cells")
    args.add_argument("--snapshots")
    args.add_argument("--zone", default="UTC")
    given = args.parse_args(argv)
    spark = build_session("log-etl", zone=given.zone)
    ranges = read_ip_ranges(spark, given.ip_ranges, given.ip_format)
    print(run_log_etl(spark, given.logs, given.process_date, given.table, ranges,
                      given.cells, given.snapshots))


if __name__ == "__main__":
    main()
