"""Connected components of links by contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.scratch import Scratch


def _relabelled(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``column`` replaced by its parent where it has one."""
    of = parents.select(F.col("u").alias(column), "p")
    return df.join(of, column, "left").withColumn(column, F.coalesce("p", column)).drop("p")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, label) for every end of ``links`` (a, b); the label is the smallest end reached.

    Each round every vertex points to its smallest neighbour, pointers are jumped to
    their roots, and the graph is contracted to the roots. Aggregates combine before
    they shuffle, so a vertex with very many links is one row per task.
    """
    edges = scratch.keep(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a <> b").distinct(), "edges")
    labels = scratch.keep(edges.select(F.explode(F.array("a", "b")).alias("u")).distinct().select(
        "u", F.col("u").alias("label")), "labels")
    while not edges.isEmpty():
        # Only the larger end of an edge can point down; roots have no parent.
        parents = scratch.keep(
            edges.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("p")), "parents")
        while True:
            onward = parents.select(F.col("u").alias("p"), F.col("p").alias("q"))
            jumped = scratch.keep(parents.join(onward, "p", "left").select(
                "u", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")),
                "jumped")
            parents = jumped.select("u", "p")
            if jumped.where("moved").isEmpty():
                break
        labels = scratch.keep(_relabelled(labels, "label", parents), "labels")
        edges = scratch.keep(
            _relabelled(_relabelled(edges, "a", parents), "b", parents)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where("a <> b").distinct(), "edges")
    return labels
