"""The ledger of consumed offsets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir import schemas, storage


# Fixed value of the source's JSON.
EARLIEST = -2


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return storage.read_keyed(spark, ledger, schemas.OFFSET_LEDGER)


def offsets_by_topic(ledger: DataFrame) -> DataFrame:
    """Per topic the JSON object of partition -> next offset to read."""
    entry = F.struct(F.col("partition").cast("string"), "until_offset")
    return ledger.groupBy("topic").agg(
        # One entry per topic partition; sorted so that the text is stable.
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("offsets")
    )


def load_offsets(spark: SparkSession, ledger: str, topic: str, default: str = "latest",
                 partitions: int = 0) -> str:
    """``startingOffsets`` for a topic, or ``default`` when nothing was saved yet.

    The source wants every partition named. Those of the topic's ``partitions`` that the
    ledger has never seen, idle or new, start at their earliest message.
    """
    rows = read_ledger(spark, ledger).where(F.col("topic") == topic).collect()
    saved = {r["partition"]: r["until_offset"] for r in rows}
    if not saved:
        return default
    named = {str(p): saved.get(p, EARLIEST) for p in sorted({*saved, *range(partitions)})}
    return json.dumps({topic: named}, separators=(",", ":"))
