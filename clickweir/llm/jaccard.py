"""Joining documents on the Jaccard similarity of their word n-grams, by vertical partitioning.

The n-grams have one global order, that of their 64-bit hashes, and every set is cut into
fragments, ranges of that order.

*Candidates.* Sets are grouped in length classes so that similar ones are in the same or in
neighbouring classes. Two similar sets of a class and the one below differ in at most D
n-grams; cut into D + 1 fragments they agree in one of them. So each set has a bucket per
fragment, its class and the class above, and similar sets share one. Equal sets are one
class from the start.

*Sketches.* Each n-gram flips one of ``SKETCH_BITS`` bits, so two sets differ in at least as many
n-grams as their sketches in bits. Candidates whose sketches differ in more bits than similar sets
of their sizes may in n-grams never become a pair. That is exact: no link is lost.

*Verification.* Wide sets never meet: each candidate pair goes once to each of
``FRAGMENTS`` fixed fragments, the partial overlaps are counted there, and their sum
decides.

Members of crowded buckets meet by their rarest n-grams instead: similar sets also share one
of their first n - ceil(n * similarity) + 1 in any one order, here by how often n-grams
occur in these sets, so what very many dissimilar documents share brings none of them
together. Inside a bucket no all-pairs list is made. First each member meets the least
member that any of its buckets has; then some members at a time are centers and meet the
members of other components. What is linked becomes one component and needs no more tests.
Rounds go on until no bucket has members of two components that have not met, so no link
is lost.

Defined results: a text without words (null, empty, blank) has no n-grams and is linked with
nothing; a shorter text than the n-gram is one. A row is judged by its own text, so rows of
one id with other texts are not linked by it. Rows without an id take part; a component's
id is its smallest, null where it has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.components import components
from clickweir.llm.scratch import Scratch
from clickweir.llm.words import distinct_sorted, mixed, shingle_hashes, slices, text_bytes, word_hashes
from clickweir.operators.joins import bounded_broadcast
from clickweir.workspace import materialized

GRAM = 3
# Linked if 100 * intersection >= SIMILARITY * union.
SIMILARITY = 90
# Fragments in which overlaps are counted.
FRAGMENTS = 4
# Bits of a set's sketch, in words of 64; with several times as many n-grams it excludes little.
SKETCH_BITS = 512
# Members of larger buckets meet by rare n-grams.
CROWD = 32
# Counters for how often n-grams occur in crowded sets, and how many are a row on their way.
COUNTERS = 1 << 20
PAGE = 1 << 14
# Buckets of more members are dealt to several tasks, about so many in each.
DEAL = 512
MORE_CENTERS = 8
# Lists up to this size are broadcast, larger ones are joined by shuffling.
BROADCAST_BYTES = 64 * 1024 * 1024


def _sets(column: pa.Array, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each text in the global order, and their bounds."""
    words, bounds = word_hashes(*text_bytes(column))
    return distinct_sorted(*shingle_hashes(words, bounds, gram))


def length_classes(longest: int, similarity: int) -> np.ndarray:
    """The least length of each class; similar sets are at most one class apart."""
    starts = [1]
    while starts[-1] <= longest:
        starts.append(starts[-1] * 100 // similarity + 1)
    return np.array(starts, dtype=np.int64)


def buckets(own: np.ndarray, starts: np.ndarray, similarity: int) -> np.ndarray:
    """A set's buckets: for its length class and the next, one per fragment."""
    lowest = int(np.searchsorted(starts, len(own), "right")) - 1
    out = []
    for kind in (lowest, lowest + 1):
        top = int(starts[kind + 1]) - 1
        differing = 2 * top * (100 - similarity) // (100 + similarity)
        pieces = differing + 1
        # Fragments are equal ranges of the upper 32 bits.
        place = ((own >> np.uint64(32)) * np.uint64(pieces)) >> np.uint64(32)
        ends = np.searchsorted(place, np.arange(pieces + 1, dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(own), dtype=np.uint64)])
        name = np.arange(pieces, dtype=np.uint64) + np.uint64(kind << 40)
        out.append(mixed(mixed(name) ^ mixed(sums[ends[1:]] - sums[ends[:-1]])))
    return np.concatenate(out)


def sketch(own: np.ndarray) -> np.ndarray:
    """For each bit of the sketch whether an odd number of n-grams fall on it, in 64-bit words."""
    at = (mixed(own) % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = (np.bincount(at, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(values.view(np.int64), pa.int64()))


def described(docs: DataFrame, id_: str, text: str, gram: int, similarity: int) -> DataFrame:
    """(id, n, digest of the set, its sketch, buckets) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = length_classes(1, similarity)
        for whole in batches:
            for batch in slices(whole, 1):
                values, bounds = _sets(batch.column(1), gram)
                n = np.diff(bounds)
                if n.max(initial=0) * 2 >= starts[-1]:
                    starts = length_classes(int(n.max()) * 4, similarity)
                own = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(n, pa.int64()),
                    pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in own],
                             pa.binary()),
                    _lists([sketch(x) for x in own]),
                    _lists([buckets(x, starts, similarity) if len(x) else x for x in own]),
                ], names=["id", "n", "digest", "sketch", "buckets"])

    kind = docs.schema[id_].dataType.simpleString()
    return docs.select(id_, text).mapInArrow(
        run, f"id {kind}, n long, digest binary, sketch array<long>, buckets array<long>")


def fragments(docs: DataFrame, text: str, gram: int) -> DataFrame:
    """(digest, fragment, grams): the sets of ``docs``, a row for each fixed fragment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS)
        seen = set()
        for whole in batches:
            for batch in slices(whole, 0):
                values, bounds = _sets(batch.column(0), gram)
                digests, places, parts = [], [], []
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    own = values[lo:hi]
                    digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    if digest in seen:
                        continue
                    seen.add(digest)
                    for k, part in enumerate(np.split(own, np.searchsorted(own, borders))):
                        if len(part):
                            digests.append(digest)
                            places.append(k)
                            parts.append(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(places, pa.int32()), _lists(parts)],
                    names=["digest", "fragment", "grams"])

    return docs.select(text).mapInArrow(run, "digest binary, fragment int, grams array<long>")


def _occurrences(texts: DataFrame, text: str, gram: int) -> np.ndarray:
    """How many of the sets have n-grams that fall on each counter, summed page by page."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(COUNTERS, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, 0):
                values, _ = _sets(batch.column(0), gram)
                np.add.at(sums, (values % np.uint64(COUNTERS)).astype(np.int64), 1)
        pages = [(k, sums[at:at + PAGE].tobytes()) for k, at in enumerate(
            range(0, COUNTERS, PAGE)) if sums[at:at + PAGE].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in pages], pa.int32()),
             pa.array([x for _, x in pages], pa.binary())], names=["page", "sums"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("sums"))
        return pa.table({"page": table.column("page")[:1], "sums": pa.array([total.tobytes()])})

    counts = np.zeros(COUNTERS, dtype=np.int64)
    for row in texts.select(text).mapInArrow(counted, "page int, sums binary").groupBy(
            "page").applyInArrow(added, "page int, sums binary").collect():
        sums = np.frombuffer(row["sums"], np.int64)
        counts[row["page"] * PAGE:row["page"] * PAGE + len(sums)] = sums
    return counts


def rare_grams(docs: DataFrame, text: str, gram: int, similarity: int,
               counts: np.ndarray) -> DataFrame:
    """(digest, gram): what similar sets share one of, the rarest n-grams first."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                values, bounds = _sets(batch.column(0), gram)
                digests, parts = [], []
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    own, n = values[lo:hi], int(hi - lo)
                    order = np.lexsort(
                        (own, shared.value[(own % np.uint64(COUNTERS)).astype(np.int64)]))
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    parts.append(own[order[:n + (-n * similarity // 100) + 1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), _lists(parts)], names=["digest", "grams"])

    return docs.select(text).mapInArrow(run, "digest binary, grams array<long>").select(
        "digest", F.explode("grams").alias("gram"))


def _least(members: DataFrame, group: list[str], n: int) -> DataFrame:
    """The ``n`` least nodes of each group. By deals first, no task sorts a whole bucket."""
    window = Window.partitionBy(*group).orderBy("node")
    return members.withColumn("rank", F.row_number().over(window)).where(
        F.col("rank") <= n).drop("rank")


def _deal() -> Column:
    return F.pmod(F.xxhash64("node"), F.col("deals"))


class _Join:
    """One run of the join: its tables and the rounds over them."""

    def __init__(self, docs: DataFrame, id_: str, text: str, gram: int, similarity: int,
                 scratch: Scratch):
        self.docs, self.id, self.text = docs, id_, text
        self.gram, self.similarity, self.scratch = gram, similarity, scratch
        self.rows = scratch.keep(described(docs, id_, text, gram, similarity).withColumn(
            "row", F.monotonically_increasing_id()), "described")
        # A class per set, named by one of its stored rows. Rows of the table with the
        # class's smallest id show its text again.
        self.classes = scratch.keep(
            self.rows.where("n > 0").groupBy("digest").agg(
                F.min("id").alias("holder"), F.first("n").alias("n"),
                F.min("row").alias("node")), "classes")

    def members(self) -> DataFrame:
        """(bucket, node, n, deals) of buckets with several sets, crowded ones replaced."""
        nodes = self.scratch.keep(self.classes.select(F.col("node").alias("row")), "nodes")
        every = self.rows.select("row", "n", "buckets").join(
            bounded_broadcast(nodes, BROADCAST_BYTES), "row", "left_semi").select(
            F.explode("buckets").alias("bucket"), F.col("row").alias("node"), "n")
        members = self._in_company(every, "members")
        crowded = self.scratch.keep(members.where(F.col("size") > CROWD).select(
            "node", "n").distinct(), "crowded")
        members = members.where(F.col("size") <= CROWD)
        if not crowded.isEmpty():
            members = members.unionByName(self._in_company(self.by_rare_grams(crowded), "rare"))
        return members.drop("size")

    def _in_company(self, members: DataFrame, label: str) -> DataFrame:
        """The members of buckets that have several, with the size and number of deals."""
        sizes = self.scratch.keep(members.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("size")).where("size > 1").withColumn(
            "deals", F.ceil(F.col("size") / DEAL).cast("int")), f"{label}-sizes")
        return self.scratch.keep(
            members.join(bounded_broadcast(sizes, BROADCAST_BYTES), "bucket"), label)

    def texts(self, nodes: DataFrame) -> DataFrame:
        """The texts of the rows that show the sets of ``nodes``, and maybe some more."""
        holders = self.scratch.keep(self.classes.join(
            bounded_broadcast(nodes, BROADCAST_BYTES), "node", "left_semi").select(
            F.col("holder").alias("_holder")).distinct(), "holders")
        return self.docs.select(F.col(self.id).alias("_id"), F.col(self.text).alias("_text")).join(
            bounded_broadcast(holders, BROADCAST_BYTES),
            F.col("_id").eqNullSafe(F.col("_holder")), "left_semi")

    def sets(self, pairs: DataFrame) -> DataFrame:
        """(node, fragment, grams) of the ends of ``pairs``."""
        ends = self.scratch.keep(
            pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
        named = self.scratch.keep(self.classes.join(
            bounded_broadcast(ends, BROADCAST_BYTES), "node", "left_semi").select(
            "digest", "node"), "ends-named")
        sets = self.scratch.keep(fragments(self.texts(ends), "_text", self.gram).join(
            bounded_broadcast(named, BROADCAST_BYTES), "digest").select(
            "node", "fragment", "grams", F.monotonically_increasing_id().alias("row")), "sets")
        # Repeated rows show a set in several tasks; only narrow columns tell.
        shown = sets.select("node", "fragment", "row")
        several = self.scratch.keep(shown.groupBy("node", "fragment").agg(
            F.min("row").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1"),
            "several")
        again = self.scratch.keep(shown.join(
            bounded_broadcast(several, BROADCAST_BYTES), ["node", "fragment"]).where(
            "row > first").select("row"), "again")
        return sets.join(bounded_broadcast(again, BROADCAST_BYTES), "row", "left_anti").drop("row")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar: partial overlaps counted by fragment, and summed."""
        sets = self.sets(pairs)
        left = sets.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("of_a"))
        right = sets.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("of_b"))
        partial = pairs.withColumn("fragment", F.explode(F.sequence(
            F.lit(0), F.lit(FRAGMENTS - 1)))).join(right, ["b", "fragment"]).join(
            left, ["a", "fragment"]).select(
            "a", "b", "sizes", F.size(F.array_intersect("of_a", "of_b")).alias("common"))
        return partial.groupBy("a", "b", "sizes").agg(F.sum("common").alias("common")).where(
            100 * F.col("common") >= self.similarity * (F.col("sizes") - F.col("common"))).select(
            "a", "b")

    def by_rare_grams(self, crowded: DataFrame) -> DataFrame:
        """(bucket, node, n): a bucket for each rare n-gram of the sets in ``crowded``."""
        nodes = crowded.select("node")
        texts = self.texts(nodes)
        counts = _occurrences(texts, "_text", self.gram)
        named = self.scratch.keep(self.classes.join(
            bounded_broadcast(nodes, BROADCAST_BYTES), "node", "left_semi").select(
            "digest", "node", "n"), "named")
        # Repeated rows show a set several times.
        return rare_grams(texts, "_text", self.gram, self.similarity, counts).join(
            bounded_broadcast(named, BROADCAST_BYTES), "digest").select(
            F.col("gram").alias("bucket"), "node", "n").distinct()

    def linked(self) -> DataFrame | None:
        """(u, label) of the nodes that have links; None without any."""
        sketches = self.rows.select(F.col("row").alias("node"), "sketch")
        waiting = self.scratch.keep(self.members().withColumn("label", F.col("node")).join(
            sketches, "node"), "waiting")
        links, labels, tested, centers = None, None, None, 0
        while not waiting.isEmpty():
            chosen = self._centers(waiting, max(centers, 1))
            pairs = self._pairs(waiting, chosen)
            if not centers:
                # To begin with, one pair for each member.
                pairs = pairs.groupBy("b").agg(F.min(F.struct("a", "sizes")).alias("least")).select(
                    "least.a", "b", "least.sizes")
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = self.scratch.keep(pairs, "pairs")
            found = self.scratch.keep(self.confirmed(pairs), "links")
            links = found if links is None else links.union(found)
            now = pairs.select("a", "b")
            tested = now if tested is None else tested.union(now)
            if not found.isEmpty():
                labels = components(links, self.scratch)
            waiting = self._still_open(waiting, chosen if centers else chosen.limit(0), labels)
            centers = centers * MORE_CENTERS or 1
        return labels

    def _centers(self, waiting: DataFrame, centers: int) -> DataFrame:
        """The least members of each bucket."""
        dealt = waiting.withColumn("deal", _deal())
        return self.scratch.keep(
            _least(_least(dealt, ["bucket", "deal"], centers), ["bucket"], centers).select(
                "bucket", F.col("node").alias("a"), F.col("label").alias("label_a"),
                F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"), "deals"), "centers")

    def _pairs(self, waiting: DataFrame, chosen: DataFrame) -> DataFrame:
        """(a, b, sizes): centers with later members of other components, if of fitting size
        and sketch."""
        everywhere = chosen.withColumn("deal", F.explode(F.sequence(
            F.lit(0).cast("long"), F.col("deals").cast("long") - 1))).drop("deals")
        small, large = F.least("n", "n_a"), F.greatest("n", "n_a")
        apart = sum(F.bit_count(F.get("sketch", F.lit(k)).bitwiseXOR(F.get("sketch_a", F.lit(k))))
                    for k in range(SKETCH_BITS // 64))
        return waiting.withColumn("deal", _deal()).join(everywhere, ["bucket", "deal"]).where(
            (F.col("a") < F.col("node")) & (F.col("label_a") != F.col("label"))
            & (100 * small >= self.similarity * large)
            # Similar sets differ in at most this share of their sizes' sum.
            & ((100 + self.similarity) * apart <= (100 - self.similarity) * (
                F.col("n") + F.col("n_a")))).select(
            "a", F.col("node").alias("b"), (F.col("n") + F.col("n_a")).alias("sizes")).distinct()

    def _still_open(self, waiting: DataFrame, chosen: DataFrame,
                    labels: DataFrame | None) -> DataFrame:
        """Members that were no center yet, of buckets that hold several components."""
        used = chosen.select("bucket", F.col("a").alias("node"))
        rest = waiting.join(used, ["bucket", "node"], "left_anti")
        if labels is not None:
            rest = rest.drop("label").join(
                labels.withColumnRenamed("u", "node"), "node", "left").withColumn(
                "label", F.coalesce("label", "node"))
        rest = self.scratch.keep(rest, "rest")
        open_ = self.scratch.keep(rest.groupBy("bucket").agg(
            F.min("label").alias("low"), F.max("label").alias("high")).where(
            "low <> high").select("bucket"), "open")
        return self.scratch.keep(rest.join(
            bounded_broadcast(open_, BROADCAST_BYTES), "bucket", "left_semi"), "waiting")


def similarity_classes(docs: DataFrame, id_: str = "doc_id", text: str = "text",
                       gram: int = GRAM, similarity: int = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: its id, n_shingles and component_id."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    join = _Join(docs, id_, text, gram, similarity, scratch)
    labels, classes = join.linked(), join.classes.select("digest", "node", "holder")
    if labels is not None:
        labels = labels.withColumnRenamed("u", "node")
        least = scratch.keep(labels.join(classes, "node").groupBy("label").agg(
            F.min("holder").alias("component")), "least")
        classes = classes.join(
            labels.join(bounded_broadcast(least, BROADCAST_BYTES), "label").select("node", "component"), "node",
                               "left").withColumn("holder", F.coalesce("component", "holder"))
    named = scratch.keep(classes.select("digest", F.col("holder").alias("component_id")), "named")
    found = join.rows.select("id", "n", "digest").join(
        bounded_broadcast(named, BROADCAST_BYTES), "digest", "left")
    result = materialized(found.select(
        F.col("id").alias(id_), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias(
            "component_id")), "similarity-classes")
    scratch.close()
    return result
