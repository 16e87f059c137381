"""Language-model scores by deleted interpolation.

p(w | v) mixes the maximum-likelihood bigram c(v, w) / c(v), the unigram c(w) / N and
the uniform 1 / (V + 1). The three weights depend on the frequency bucket of the context
v. Expectation-maximisation learns them on held-out counts: each training document is
held out in turn, its own counts deleted from those of the whole training corpus.

Counting and looking up go by blocks of documents. A block sends every distinct key once
with its count, so the most frequent word is one entry per block; keys are dealt to
parts by ranges of their hash, a part sums its keys and answers each block in the order
of its request, and the block's documents meet the answers by the block's number. No key
and no model is gathered anywhere. Keys are 64-bit hashes.

Blocks are numbered by where a document is read, so ``docs`` must be read from files or a
written table; a block that no longer holds what it sent fails.

Defined results: a null or empty text is its end token alone. A document scores by its
own text only, so repeated rows agree; a null id trains. Without training text all
weight is on the uniform part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.scratch import Scratch
from clickweir.llm.words import mixed, text_bytes, word_hashes
from clickweir.workspace import materialized

# Text of a block; bounds what a task holds.
BLOCK_BYTES = 6 * 1024 * 1024
# Text whose keys one part sums.
PART_BYTES = 12 * 1024 * 1024
EM_ROUNDS = 100
# Weights are kept for context counts of 0, 1, 2-3, 4-7, ...
BUCKETS = 48
# Held-out counts are summed in cells: probabilities in steps of half a power of two.
_STEPS = 2
_LEVELS = 1 + 60 * _STEPS
_END = mixed(np.array([0x656E64], dtype=np.uint64))[0]
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers byte plane by byte plane, as small ones compress well that way."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, dtype=np.uint8).reshape(size, len(data) // size)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def packed_counts(values: np.ndarray) -> bytes:
    """Counts packed in the narrowest of 1, 2, 4 and 8 bytes that holds them all; the width leads."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + packed(values.astype(kind))


def unpacked_counts(data: bytes) -> np.ndarray:
    return unpacked(data[1:], np.dtype(f"u{data[0]}")).astype(np.uint64)


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, bigrams and bounds of the texts; every text ends in the end token."""
    words, bounds = word_hashes(*text_bytes(column))
    tokens = np.insert(words, bounds[1:], _END)
    bounds = bounds + np.arange(len(bounds))
    before = np.empty_like(tokens)
    if len(tokens):
        before[0], before[1:] = _END, tokens[:-1]
    return tokens, mixed(before * _PAIR + tokens), bounds


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (id, trains, text) with the number of their block in front."""
    first, number, size = TaskContext.get().partitionId() << 32, 0, 0
    for batch in batches:
        blocks = []
        for n in pa.compute.binary_length(batch.column(2)).to_pylist():
            if size and size + (n or 0) > BLOCK_BYTES:
                number, size = number + 1, 0
            size += (n or 0) + 1
            blocks.append(first + number)
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int64()), *batch.columns], names=["block", "id", "trains", "text"])


def blocked(docs: DataFrame) -> DataFrame:
    """(block, id, trains, text): documents in blocks of bounded size, in reading order."""
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(_numbered, f"block long, id {kind}, trains boolean, text string")


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each block together; a block lies within one task."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = batch.slice(lo, hi - lo)
            if held and part.num_rows and held[0].column(0)[0] != part.column(0)[0]:
                yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)
                held = []
            if part.num_rows:
                held.append(part)
    if held:
        yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)


def _trained(table: pa.Table, bounds: np.ndarray) -> np.ndarray:
    return np.repeat(table.column("trains").to_numpy(), np.diff(bounds))


def requests(docs: DataFrame, parts: int) -> DataFrame:
    """(part, block, keys, counts): what each block has of each part's range of keys.

    Parts from 0 have words, parts from ``parts`` on have bigrams.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table in _whole_blocks(_numbered(batches)):
            tokens, pairs, bounds = _sequences(table.column("text").combine_chunks())
            trained = _trained(table, bounds)
            for first, keys in ((0, tokens), (parts, pairs)):
                distinct, inverse = np.unique(keys, return_inverse=True)
                counts = np.bincount(inverse, weights=trained, minlength=len(distinct)).astype(
                    np.uint64)
                part = part_of(distinct, parts)
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
                spans = list(zip(cuts, cuts[1:]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([first + int(part[lo]) for lo, _ in spans], pa.int32()),
                    pa.array([block] * len(spans), pa.int64()),
                    pa.array([packed(np.diff(distinct[lo:hi], prepend=np.uint64(0)))
                              for lo, hi in spans], pa.binary()),
                    pa.array([packed_counts(counts[lo:hi]) for lo, hi in spans], pa.binary()),
                ], names=["part", "block", "keys", "counts"])

    return docs.mapInArrow(run, "part int, block long, keys binary, counts binary")


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Ascending keys go to ascending parts."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def answers(asked: DataFrame) -> DataFrame:
    """(block, part, counts, kinds, total): sums of each part in the order of the request.

    ``kinds`` and ``total`` are the part's distinct and all training keys, on one row.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys = [np.cumsum(unpacked(x.as_py(), np.uint64), dtype=np.uint64)
                for x in table.column("keys")]
        counts = np.concatenate([unpacked_counts(x.as_py()) for x in table.column("counts")])
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        # Sums of a double are exact up to 2^53.
        sums = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.uint64)
        found = sums[inverse]
        ends = np.cumsum([len(k) for k in keys])
        first = [True] + [False] * (len(keys) - 1)
        return pa.table({
            "block": table.column("block"), "part": table.column("part"),
            "counts": pa.array([packed_counts(found[e - len(k):e]) for k, e in zip(keys, ends)],
                               pa.binary()),
            "kinds": pa.array([int((sums > 0).sum()) if f else 0 for f in first], pa.int64()),
            "total": pa.array([int(sums.sum()) if f else 0 for f in first], pa.int64())})

    return asked.groupBy("part").applyInArrow(
        run, "block long, part int, counts binary, kinds long, total long")


def _level(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Step of count / of, 0 where it is 0."""
    with np.errstate(divide="ignore", invalid="ignore"):
        step = np.rint(-_STEPS * np.log2(count / of)).astype(np.float64)
    return np.where((count > 0) & (of > 0), 1 + np.clip(np.nan_to_num(step), 0, _LEVELS - 2), 0)


def bucket_of(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(count.astype(np.float64) + 1)), BUCKETS - 1).astype(np.int64)


def _own(inverse: np.ndarray, size: int, doc: np.ndarray) -> np.ndarray:
    """How often each token's key occurs in its own document."""
    _, at, n = np.unique(doc * size + inverse, return_inverse=True, return_counts=True)
    return n[at]


def looked_up(blocks: DataFrame, found: DataFrame, parts: int, total: int) -> DataFrame:
    """Rows of documents with the counts of their tokens, and of blocks with held-out cells."""
    kind = blocks.schema["id"].dataType.simpleString()

    def run(docs: pa.Table, sums: pa.Table) -> pa.Table:
        order = np.argsort(sums.column("part").to_numpy(), kind="stable")
        part = sums.column("part").to_numpy()[order]
        blobs = sums.column("counts").combine_chunks().take(pa.array(order))
        tokens, pairs, bounds = _sequences(docs.column("text").combine_chunks())
        lengths = np.diff(bounds)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        counts, owned = [], []
        for chosen, keys in ((part < parts, tokens), (part >= parts, pairs)):
            distinct, inverse = np.unique(keys, return_inverse=True)
            answer = [unpacked_counts(blobs[int(i)].as_py()) for i in np.flatnonzero(chosen)]
            answer = np.concatenate(answer) if answer else np.zeros(0, np.uint64)
            if len(answer) != len(distinct):
                raise RuntimeError("a block has changed since it was counted: write docs first")
            counts.append(answer[inverse])
            owned.append(_own(inverse, len(distinct), doc))
        word, pair = counts
        context, own_context = np.empty_like(word), np.empty_like(owned[0])
        # The context of a first word is the end token, which every document has once.
        context[bounds[:-1]], own_context[bounds[:-1]] = word[bounds[1:] - 1], 1
        inner = np.ones(len(word), dtype=bool)
        inner[bounds[:-1]] = False
        inner = np.flatnonzero(inner)
        context[inner], own_context[inner] = word[inner - 1], owned[0][inner - 1]
        held = _trained(docs, bounds)
        left = [np.maximum(c[held].astype(np.int64) - o[held], 0)
                for c, o in ((word, owned[0]), (pair, owned[1]), (context, own_context))]
        cells = ((bucket_of(left[2]) * _LEVELS + _level(left[1], left[2])) * _LEVELS
                 + _level(left[0], np.float64(max(total, 1)))).astype(np.int64)
        cells, n = np.unique(cells, return_counts=True)
        spans = list(zip(bounds[:-1], bounds[1:]))
        rows = len(spans)
        return pa.table({
            "id": pa.chunked_array([*docs.column("id").chunks,
                                    pa.nulls(1, docs.column("id").type)]),
            "n_tokens": pa.array([*lengths.tolist(), None], pa.int64()),
            "words": pa.array([*[packed_counts(word[a:b]) for a, b in spans], None], pa.binary()),
            "pairs": pa.array([*[packed_counts(pair[a:b]) for a, b in spans], None], pa.binary()),
            "trains": pa.array([*docs.column("trains").to_pylist(), None], pa.bool_()),
            "cells": pa.array([None] * rows + [cells.tolist()], pa.list_(pa.int64())),
            "times": pa.array([None] * rows + [n.tolist()], pa.list_(pa.int64())),
        })

    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        run, f"id {kind}, n_tokens long, words binary, pairs binary, trains boolean, "
             "cells array<long>, times array<long>")


def learned(cells: np.ndarray, times: np.ndarray, kinds: int, rounds: int = EM_ROUNDS
            ) -> np.ndarray:
    """Weights (bucket, [bigram, unigram, uniform]) by expectation-maximisation."""
    weights = np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    if not len(cells):
        return weights
    one, two, bucket = cells % _LEVELS, cells // _LEVELS % _LEVELS, cells // _LEVELS ** 2

    def share(level: np.ndarray) -> np.ndarray:
        return np.where(level > 0, np.exp2(-(level - 1) / _STEPS), 0.0)

    parts = np.stack([share(two), share(one), np.full(len(cells), 1 / (kinds + 1))], axis=1)
    mixed_ = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(rounds):
        joint = parts * mixed_[bucket]
        joint *= (times / joint.sum(1))[:, None]
        sums = np.stack([np.bincount(bucket, joint[:, k], BUCKETS) for k in range(3)], axis=1)
        # A thousandth of an observation keeps every weight above 0.
        mixed_ = (sums + 0.001) / (sums + 0.001).sum(1, keepdims=True)
    # A bucket without held-out tokens is mixed like the nearest that has some.
    seen = np.flatnonzero(np.bincount(bucket, times, BUCKETS) > 0)
    nearest = seen[np.abs(np.arange(BUCKETS)[:, None] - seen).argmin(1)]
    weights = mixed_[nearest]
    # An unseen context has no bigram share.
    weights[0] = [0.0, *(weights[0, 1:] / weights[0, 1:].sum())]
    return weights


def scored(counted: DataFrame, weights: np.ndarray, total: int, kinds: int) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of each counted document."""
    kind = counted.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, base, score = [], [], []
            for words, pairs in zip(batch.column(2), batch.column(3)):
                w = unpacked_counts(words.as_py()).astype(np.float64)
                vw = unpacked_counts(pairs.as_py()).astype(np.float64)
                v = np.concatenate([w[-1:], w[:-1]])
                mix = weights[bucket_of(v)]
                p = (mix[:, 0] * vw / np.maximum(v, 1) + mix[:, 1] * w / max(total, 1)
                     + mix[:, 2] / (kinds + 1))
                known.append(int((w > 0).sum()))
                base.append(float(np.log10((w + 0.5) / (total + 0.5 * (kinds + 1))).sum()))
                score.append(float(np.log10(p).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(score, pa.float64()), batch.column(4)],
                names=["id", "n_tokens", "n_known", "base_score", "score", "trains"])

    return counted.select("id", "n_tokens", "words", "pairs", "trains").mapInArrow(
        run, f"id {kind}, n_tokens long, n_known long, base_score double, score double, "
             "trains boolean")


def score(docs: DataFrame, trains: Column, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows where ``trains`` holds and score all: id, trains, n_tokens,
    n_known, train_tokens, base_score (unigram, add one half), score (base-10 logarithms)."""
    scratch = Scratch(docs.sparkSession, "lm")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    rows = docs.select(F.col(id_).alias("id"), trains.alias("trains"), F.col(text).alias("text"))
    blocks = blocked(rows)
    found = scratch.keep(answers(requests(rows, parts)), "answers")
    sums = found.where(F.col("part") < parts).agg(F.sum("kinds"), F.sum("total")).first()
    kinds, total = sums[0] or 0, sums[1] or 0
    path = scratch.folder("counted")
    looked_up(blocks, found, parts, total).write.option("compression", "zstd").parquet(path)
    counted = docs.sparkSession.read.parquet(path)
    cells = counted.where("cells IS NOT NULL").select(
        F.explode(F.arrays_zip("cells", "times")).alias("c")).groupBy("c.cells").agg(
        F.sum("c.times").alias("times")).collect()
    weights = learned(np.array([r["cells"] for r in cells], dtype=np.int64),
                      np.array([r["times"] for r in cells], dtype=np.float64), kinds)
    result = materialized(scored(counted.where("n_tokens IS NOT NULL"), weights, total, kinds)
                          .withColumn("train_tokens", F.lit(total).cast("long"))
                          .withColumnRenamed("id", id_), "lm-scores")
    scratch.close()
    return result
