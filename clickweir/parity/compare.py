"""Compare registered queries with their DuckDB oracle on one data folder."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from clickweir.parity.oracle import ORACLE_SQL
from clickweir.parity.queries import QUERIES
from clickweir.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _canonical(rows, names: list[str]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        return repr(round(v, 6)) if isinstance(v, float) and math.isfinite(v) else repr(v)

    return Counter(tuple(value(row[i]) for i in order) for row in rows)


def differences(spark, connection, name: str, sf_dir: str) -> list[str]:
    """Human-readable differences between the query and its oracle; empty when equal."""
    frame = QUERIES[name](spark, sf_dir)
    ours = _canonical([tuple(r) for r in frame.collect()], frame.columns)
    answer = connection.execute(ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    theirs = _canonical(answer.fetchall(), columns)
    found = []
    if sorted(frame.columns) != sorted(columns):
        found.append(f"columns {sorted(frame.columns)} != {sorted(columns)}")
    if ours != theirs:
        found.append(f"{ours.total()} rows against {theirs.total()}")
        found += [f"only ours   {r}" for r in list((ours - theirs))[:3]]
        found += [f"only oracle {r}" for r in list((theirs - ours))[:3]]
    if not ours:
        found.append("no rows")
    return found


def main() -> None:
    sf_dir, *names = sys.argv[1:]
    spark = build_session("parity", "local[8]", settings={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names or QUERIES:
        begun = time.time()
        try:
            found = differences(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - begun:.1f}s", flush=True)
        for line in found:
            print("     ", line)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
