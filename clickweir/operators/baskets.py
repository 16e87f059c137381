"""What is bought together: frequent item sets and the rules between them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.operators.joins import bounded_broadcast
from clickweir.operators.shaping import pieces_of
from clickweir.workspace import materialized

# What a task sorts or counts: about so many rows, in files and shuffles of so many bytes.
TASK_ROWS = 250_000
TASK_BYTES = "4m"
# Lists up to this size are broadcast, larger ones are joined by shuffling.
BROADCAST_BYTES = 64 * 1024 * 1024


@contextmanager
def _dealt(spark: SparkSession, pieces: int) -> Iterator[None]:
    """Jobs that start inside shuffle to ``pieces`` tasks, one per core at least, of small size.

    Pairs and sets are a few bytes a row in files and shuffles and ten times that when they are
    sorted or counted, so sizes that suit wide rows would give a task as much as its memory holds.
    """
    settings = {
        "spark.sql.shuffle.partitions": str(max(pieces, spark.sparkContext.defaultParallelism)),
        "spark.sql.files.maxPartitionBytes": TASK_BYTES,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def baskets_of(rows: DataFrame, basket: str, item: str, min_count: int) -> DataFrame:
    """(items) of each basket, as far as ``min_count`` baskets or more have them.

    Rows without basket or item are left out, repeats within a basket count once. Rare items
    go before a basket is gathered, since no set with one of them is frequent.
    """
    pairs = materialized(
        rows.select(F.col(basket).alias("basket"), F.col(item).alias("item")).where(
            "basket IS NOT NULL AND item IS NOT NULL").distinct(), "pairs")
    common = materialized(pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= min_count).select("item"), "common")
    return pairs.join(bounded_broadcast(common, BROADCAST_BYTES), "item").groupBy("basket").agg(
        F.collect_set("item").alias("items")).select("items")


def _total(df: DataFrame, of: Column) -> int:
    return int(df.agg(F.sum(of).alias("total")).first()["total"] or 0)


def _of_level(counted: DataFrame, min_count: int, parts: int | None) -> DataFrame:
    """Stored (prefix, item, n) of the sets that ``min_count`` baskets or more have."""
    keys = ["prefix", "item"]
    dealt = counted.groupBy(*keys).agg(F.sum("weight").alias("n"))
    if parts:
        dealt = counted.repartition(parts, *keys).groupBy(*keys).agg(F.sum("weight").alias("n"))
    return materialized(dealt.where(F.col("n") >= min_count), "sets")


def frequent_sets(rows: DataFrame, basket: str, item: str, min_count: int,
                  parts: int | None = None) -> DataFrame:
    """(items, n_baskets) of every set of items that ``min_count`` baskets or more have whole.

    Sets grow by one item a level. Equal baskets are one row with a weight. A basket is a row per
    frequent set (``prefix``) it has, with the later items that make another frequent set of it
    (``tails``); each of these with each later one is a candidate. Candidates are counted by a
    shuffle, so no tree or list of items is kept in a task or the driver, and a frequent item is
    one row per map task. Tasks are dealt by counted rows, so what one holds does not grow with
    the input. ``parts`` is the number of the counting shuffle's tasks, by rows if not given.
    """
    spark, kind = rows.sparkSession, rows.schema[item].dataType.simpleString()
    with _dealt(spark, pieces_of(rows, TASK_ROWS)):
        gathered = baskets_of(rows, basket, item, min_count).groupBy(
            F.sort_array("items").alias("tails")).agg(F.count(F.lit(1)).alias("weight"))
        held = materialized(gathered.select(
            F.monotonically_increasing_id().alias("basket"), "weight",
            F.expr(f"CAST(array() AS array<{kind}>)").alias("prefix"), "tails"), "baskets")
    grown = held.select("basket", "weight", "prefix", F.explode("tails").alias("item"))
    candidates, levels = _total(held, F.size("tails")), []
    while True:
        with _dealt(spark, ceil(candidates / TASK_ROWS)):
            found = _of_level(grown, min_count, parts)
            if levels and found.isEmpty():
                break
            levels.append(found.select(
                F.concat("prefix", F.array("item")).alias("items"), F.col("n").alias("n_baskets")))
            if len(levels) > 1:
                wanted = bounded_broadcast(found.select("prefix", "item"), BROADCAST_BYTES)
                held = materialized(
                    grown.join(wanted, ["prefix", "item"])
                    .groupBy("basket", "weight", "prefix")
                    .agg(F.sort_array(F.collect_list("item")).alias("tails"))
                    .where(F.size("tails") > 1), "baskets")
        candidates = _total(held, F.size("tails") * (F.size("tails") - 1) / 2)
        heads = held.where(F.size("tails") > 1).select(
            "*", F.explode(F.sequence(F.lit(1), F.size("tails") - 1)).alias("at"))
        grown = heads.select(
            "basket", "weight",
            F.concat("prefix", F.array(F.element_at("tails", F.col("at")))).alias("prefix"),
            F.explode(F.slice("tails", F.col("at") + 1, F.size("tails"))).alias("item"))
    return reduce(DataFrame.unionByName, levels)


def rules_between(rows: DataFrame, basket: str, item: str, min_count: int, confidence: float,
                  parts: int | None = None) -> DataFrame:
    """(antecedent, consequent, confidence) of frequent sets: of the baskets with all of
    ``antecedent`` the share that has ``consequent`` too, if it is ``confidence`` or more."""
    spark = rows.sparkSession
    sets = frequent_sets(rows, basket, item, min_count, parts)
    cuts = _total(sets, F.when(F.size("items") > 1, F.size("items")).otherwise(0))
    cut = sets.where(F.size("items") > 1).select(
        "items", "n_baskets", F.explode("items").alias("consequent")).select(
        F.filter("items", lambda x: x != F.col("consequent")).alias("antecedent"),
        "consequent", F.col("n_baskets").alias("n"))
    share = (F.col("n") / F.col("n_baskets")).alias("confidence")
    with _dealt(spark, ceil((cuts + sets.count()) / TASK_ROWS)):
        cut = materialized(cut, "cut")
        return materialized(
            sets.withColumnRenamed("items", "antecedent").join(
                bounded_broadcast(cut, BROADCAST_BYTES), "antecedent").select(
                "antecedent", "consequent", share).where(F.col("confidence") >= confidence),
            "rules")
