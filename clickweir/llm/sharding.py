"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table; the shards
take turns, each claiming the first slot of its permutation that is still free. A row's
key is hashed to a slot, and the broadcast table gives the slot's shard, so placing a
row takes constant time and no shuffle. When a shard leaves, few slots of the others
change hands.

Defined results: a null key has a hash like any other and so a place; equal keys share
a place; an empty table gives an empty result. Clashing columns of the input give way
to ``slot`` and ``shard``.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm.frames import position, shielded, unshielded

# A prime, well above 100 times the number of shards; it bounds what is broadcast.
SLOTS = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """For each slot the index of its shard in ``shards``."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct names, at least one and no more than slots")
    offset = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 for s in shards]
    at = list(offset)
    table = np.full(slots, -1, dtype=np.int32)
    left = slots
    while True:
        for k in range(len(shards)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % slots
            table[at[k]] = k
            left -= 1
            if not left:
                return table


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    rows = [(slot, shards[k]) for slot, k in enumerate(lookup_table(shards, slots).tolist())]
    return spark.createDataFrame(rows, "slot int, shard string")


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``."""
    rows, names = shielded(df)
    slot = F.pmod(F.xxhash64(position(df, key)), F.lit(slots)).cast("int")
    table = table_frame(df.sparkSession, shards, slots)
    placed = rows.withColumn("slot", slot).join(F.broadcast(table), "slot")
    return unshielded(placed, names, df.columns, F.col("slot"), F.col("shard"))


def write_shards(df: DataFrame, key: str, shards: list[str], path: str,
                 files_per_shard: int = 4, slots: int = SLOTS) -> None:
    """Write ``df`` under ``path/shard=<name>``; a shard is dealt to several tasks."""
    placed = place(df, key, shards, slots)
    salt = F.pmod(F.col("slot"), F.lit(files_per_shard))
    (placed.repartition(len(shards) * files_per_shard, "shard", salt)
     .drop("slot").write.partitionBy("shard").mode("overwrite").parquet(path))
