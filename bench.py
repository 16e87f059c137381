"""Time the registered queries; prints one JSON line.

Each query is planned and its whole result produced into Spark's no-op sink, twice;
the second, warm run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from clickweir.parity.queries import QUERIES
from clickweir.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", settings={
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or QUERIES:
        for _ in range(2):
            begun = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begun, 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
