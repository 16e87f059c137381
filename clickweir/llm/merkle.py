"""A Merkle manifest of a dataset: a hash tree per group, a tree over their roots, and proofs.

Every row is a leaf; the leaves of a group ascend by id. A node carries the half-open
interval of leaf ranks that it covers, so no node knows its children: the ancestors of
a leaf are the nodes whose intervals contain its rank, and what the parent's interval has
beyond a node's own is the sibling's. Levels are handled ``SPAN`` at a time: a bucket of
levels is joined on the block of 2^SPAN intervals that contains a rank, which bounds every
group whatever the size of a tree. Above its bucket a proof goes on with that of
the block's own root, so paths are made from the top bucket down.

H is sha256 over the concatenated inputs, digests as lowercase hex. A field enters as its
UTF-8 byte count, ``:`` and its value, and as ``-`` if it is null.

Defined results: a null id comes first, a null group is a group of its own and the first;
rows of one id are leaves in the order of their digests, equal rows equal leaves side by
side. A group of one row has its leaf as root. Without rows there are no trees.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.ranks import ranked
from clickweir.llm.scratch import Scratch
from clickweir.operators.joins import bounded_broadcast

# Levels of a bucket; a group of nodes has at most 2^SPAN leaves or roots of lower blocks.
SPAN = 10
BROADCAST_BYTES = 64 * 1024 * 1024
# Names of trees: of all groups' roots, of the null group; others are "=" and the group.
FOREST, NO_GROUP = "", "-"

_NODES = "tree string, size long, level int, lo long, hi long, digest string"
_PATHS = "siblings array<string>, sides string"


def encoded(column: Column) -> Column:
    """A field as it enters a leaf."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256)


def _climbed(level: int):
    """Nodes above a block's nodes of ``level``, up to the block's or the tree's root."""

    def run(block: pa.Table) -> pa.Table:
        tree, size = block.column("tree")[0].as_py(), block.column("size")[0].as_py()
        nodes = sorted(zip(*(block.column(c).to_pylist() for c in ("lo", "hi", "digest"))))
        made = []
        for at in range(level + 1, level + SPAN + 1):
            if nodes[0][:2] == (0, size):
                break
            parents: list[tuple[int, int, str]] = []
            # Neighbours whose ranks agree above the level's bits have one parent.
            for lo, hi, digest in nodes:
                if parents and parents[-1][0] >> at == lo >> at:
                    first, _, text = parents.pop()
                    parents.append((first, hi, text + digest))
                else:
                    parents.append((lo, hi, digest))
            nodes = [(lo, hi, sha256(text.encode()).hexdigest()) for lo, hi, text in parents]
            made += [(tree, size, at, *node) for node in nodes]
        columns = list(zip(*made)) or [[]] * 6
        types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.table({name: pa.array(column, kind) for name, column, kind in zip(
            ("tree", "size", "level", "lo", "hi", "digest"), columns, types)})

    return run


def _in_block(rows: DataFrame, bucket: int) -> DataFrame:
    """With ``block``: which interval of the bucket's last level contains the row's."""
    return rows.withColumn("block", F.shiftright("lo", (bucket + 1) * SPAN))


def grown(leaves: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """The nodes above stored ``leaves`` (tree, size, lo, digest), a table per bucket of levels."""
    buckets = []
    nodes = leaves.select("tree", "size", "lo", (F.col("lo") + 1).alias("hi"), "digest")
    while True:
        k = len(buckets)
        buckets.append(scratch.keep(_in_block(nodes, k).groupBy("tree", "block").applyInArrow(
            _climbed(k * SPAN), _NODES), f"nodes-{k}"))
        nodes = buckets[-1].where(
            (F.col("level") == (k + 1) * SPAN) & (F.col("hi") - F.col("lo") < F.col("size")))
        if nodes.isEmpty():
            return buckets


def _contained(bucket: int):
    """Siblings on the way up for every item, from the nodes and paths of its block."""

    def run(items: pa.Table, above: pa.Table) -> pa.Table:
        if not items.num_rows:
            return items.append_column("siblings", pa.array([], pa.list_(pa.string()))).append_column(
                "sides", pa.array([], pa.string()))
        levels: dict[int, dict[int, tuple[int, str]]] = {}
        path: tuple[list[str], str] = ([], "")
        for level, lo, hi, digest, siblings, sides in zip(*(above.column(c).to_pylist() for c in (
                "level", "lo", "hi", "digest", "siblings", "sides"))):
            if level < 0:
                path = (siblings, sides)
            else:
                levels.setdefault(level, {})[lo] = (hi, digest)
        low = bucket * SPAN
        levels[low] = {lo: (hi, digest) for lo, hi, digest in zip(
            *(items.column(c).to_pylist() for c in ("lo", "hi", "digest")))}
        top = max(levels)
        paths = {lo: path for lo in levels[top]}
        for level in range(top - 1, low - 1, -1):
            below = {}
            for lo, (hi, _) in levels[level].items():
                parent = lo >> (level + 1) << (level + 1)
                siblings, sides = paths[parent]
                # What the parent covers beyond this node: before it, after it or nothing.
                if parent < lo:
                    below[lo] = ([levels[level][parent][1], *siblings], "<" + sides)
                elif hi < levels[level + 1][parent][0]:
                    below[lo] = ([levels[level][hi][1], *siblings], ">" + sides)
                else:
                    below[lo] = (["", *siblings], "-" + sides)
            paths = below
        found = [paths[lo] for lo in items.column("lo").to_pylist()]
        return items.append_column(
            "siblings", pa.array([f[0] for f in found], pa.list_(pa.string()))).append_column(
            "sides", pa.array([f[1] for f in found], pa.string()))

    return run


def attached(leaves: DataFrame, buckets: list[DataFrame], tops: DataFrame,
             scratch: Scratch) -> DataFrame:
    """``leaves`` (tree, size, lo, digest, ...) with siblings and sides up to the last root.

    ``tops`` has what lies above each tree's root: (tree, siblings, sides). A side is
    ``<`` or ``>`` for where the sibling is, or ``-`` where a node is alone and its sibling "".
    """
    tops = leaves.where("lo = 0").select("tree", "size").join(tops, "tree")
    paths = None
    for k in range(len(buckets) - 1, -1, -1):
        items = leaves.withColumn("hi", F.col("lo") + 1) if k == 0 else buckets[k - 1].where(
            (F.col("level") == k * SPAN) & (F.col("hi") - F.col("lo") < F.col("size")))
        # Trees that end in this bucket: no more leaves than a block has, more than lower ones.
        ends = tops.where(F.col("size") <= F.lit(1).cast("long") * 2 ** ((k + 1) * SPAN))
        if k:
            ends = ends.where(F.col("size") > 2 ** (k * SPAN))
        upper = ends.select("tree", F.lit(0).cast("long").alias("block"), "siblings", "sides")
        if paths is not None:
            upper = upper.union(paths)
        none = F.lit(None)
        above = _in_block(buckets[k], k).select(
            "tree", "block", "level", "lo", "hi", "digest",
            none.cast("array<string>").alias("siblings"), none.cast("string").alias("sides")).union(
            upper.select("tree", "block", F.lit(-1), none.cast("long"), none.cast("long"),
                         none.cast("string"), "siblings", "sides"))
        items = _in_block(items, k)
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
        found = items.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(
            _contained(k), f"{kinds}, {_PATHS}")
        if k == 0:
            return found.drop("block", "hi")
        paths = scratch.keep(found.select(
            "tree", F.shiftright("lo", k * SPAN).alias("block"), "siblings", "sides"), f"paths-{k}")


def folded(leaf: Column, siblings: Column, sides: Column) -> Column:
    """The root that a leaf and its siblings lead to."""

    def step(digest: Column, at: Column) -> Column:
        sibling, side = F.element_at(siblings, at), F.substring(sides, at, F.lit(1))
        return F.sha2(F.when(side == "<", F.concat(sibling, digest)).otherwise(
            F.concat(digest, sibling)).cast("binary"), 256)

    steps = F.when(F.size(siblings) > 0, F.sequence(F.lit(1), F.size(siblings))).otherwise(
        F.array().cast("array<int>"))
    return F.aggregate(steps, leaf, step)


class Manifest:
    """The trees over a dataset, in tables that live as long as ``scratch``.

    ``leaves``: tree, size, lo (the rank), id, digest and the ``carried`` columns;
    ``nodes``: tree, level, lo, hi and digest of all inner nodes, the forest's included;
    ``roots``: tree and subroot; ``root``: the last digest, None without rows.
    """

    def __init__(self, docs: DataFrame, id_: str, group: str, fields: list[str], scratch: Scratch,
                 carried: dict[str, Column] | None = None):
        carried = carried or {}
        digests = scratch.keep(docs.select(
            F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(NO_GROUP)).alias(
                "tree"),
            F.col(id_).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
            *[c.alias(name) for name, c in carried.items()],
            F.monotonically_increasing_id().alias("_row")), "digests")
        self.leaves, self.buckets = self._trees(digests, ["id", "digest", "_row"], scratch)
        self.roots = scratch.keep(self._roots(self.leaves, self.buckets), "roots")
        forest = self.roots.select(F.lit(FOREST).alias("tree"), F.col("tree").alias("of"),
                                   F.col("subroot").alias("digest"))
        self._subroots, self._forest = self._trees(
            scratch.keep(forest, "subroots"), ["of"], scratch)
        last = self._roots(self._subroots, self._forest).first()
        self.root = last["subroot"] if last else None
        self.nodes = reduce(DataFrame.union, [*self.buckets, *self._forest])
        self._scratch = scratch

    @staticmethod
    def _trees(rows: DataFrame, order: list[str], scratch: Scratch) -> tuple[
            DataFrame, list[DataFrame]]:
        placed = ranked(rows, "tree", order, scratch)
        sizes = scratch.keep(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("size")), "sizes")
        leaves = scratch.keep(placed.join(bounded_broadcast(sizes, BROADCAST_BYTES), "tree").drop(
            "_row").withColumnRenamed("rank", "lo"), "leaves")
        return leaves, grown(leaves, scratch)

    @staticmethod
    def _roots(leaves: DataFrame, buckets: list[DataFrame]) -> DataFrame:
        """(tree, subroot): nodes that cover their whole tree, the highest for a lone one."""
        alone = leaves.where("size = 1").select("tree", "digest")
        whole = reduce(DataFrame.union, buckets).where("lo = 0 AND hi = size").select(
            "tree", "digest")
        return alone.union(whole).withColumnRenamed("digest", "subroot")

    def proofs(self) -> DataFrame:
        """``leaves`` with subroot, siblings and sides up to the root."""
        nothing = self._subroots.limit(1).select(
            "tree", F.array().cast("array<string>").alias("siblings"), F.lit("").alias("sides"))
        above = self._scratch.keep(attached(
            self._subroots, self._forest, nothing, self._scratch).select(
            F.col("of").alias("tree"), "siblings", "sides"), "forest-paths")
        return attached(self.leaves, self.buckets, above, self._scratch).join(
            bounded_broadcast(self.roots, BROADCAST_BYTES), "tree")


def verified(manifest: Manifest, claimed: str) -> DataFrame:
    """Every leaf's proof, and whether the digest in column ``claimed`` leads to the root."""
    root = F.lit(manifest.root).cast("string")
    proofs = manifest.proofs().withColumn(
        "folded_root", folded(F.col(claimed), F.col("siblings"), F.col("sides")))
    return proofs.select(
        "id", F.col("digest").alias("leaf"), "subroot", root.alias("root"),
        F.sha2(F.concat_ws("", "siblings").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == root).alias("verified"))
