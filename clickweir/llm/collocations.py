"""Collocations of 2 to ``longest`` words per language, counted by double-array tries.

Words are counted first. Frequent ones become numbers, and the texts are stored once as
numbers with 0 where a piece ends or a rare word stands, which no frequent phrase crosses.

Phrases grow a word a round. A trie of the frequent phrases of k words is broadcast, all
text positions walk it at once, a level a step, and what follows an accepted position
whose next position is accepted too is a candidate of k + 1 words: both its parts are
frequent, so no frequent phrase is missed (Apriori). Candidates that are seen too rarely over
all tasks go. In the end a trie of all candidates is walked once more; accepting states are counted by
bincount in each task and the counts are summed. Those sums are the result's counts.

A trie is broadcast in shards of at most ``SHARD_PHRASES`` phrases with their beginnings,
a pass each, whatever the number of phrases, and the words are numbered in blocks of
``BLOCK_BYTES`` the same way. With several shards a candidate's second part is not looked
at, which only leaves more candidates to be summed.

A phrase is as strong as its weakest cut, scored floor(1000 * a * n / (l * r)) in exact
decimals (products below 10^38). It gives way to a longer candidate that contains it and
occurs ``ABSORBED`` percent as often or more; as counts fall with length, only candidates
that are one word longer need to be looked at.

Defined results: a null text is empty, a null language ``und``. Rows are texts of their
own, repeated ones count each time. Equal scores go by count, then by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir.llm.ranks import ranked
from clickweir.llm.scratch import Scratch
from clickweir.llm.words import slices, text_bytes
from clickweir.operators.joins import bounded_broadcast
from clickweir.workspace import materialized

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN = "und"
# A longer phrase with this share of the count takes a phrase's place.
ABSORBED = 100
SHARD_PHRASES = 1_000_000
BLOCK_BYTES = 64 * 1024 * 1024
BROADCAST_BYTES = 64 * 1024 * 1024
# Numbers in a stored row, and numbers that walk a trie together.
ROW_NUMBERS = 1024
WALK_NUMBERS = 1_000_000
# Distinct candidates that a task holds before it hands them on.
TALLY_KEYS = 4_000_000
# States whose counts are a row on their way.
PAGE = 8192
# Rankings are cut in so many deals before a language comes together.
DEALS = 64

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


class Words:
    """The words of a text column: distinct ones, and which, whose and after what each is."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        kind = _KIND[data]
        inside = np.concatenate([[False], kind == 0, [False]])
        # A text's first byte begins a word even if the text before ended in one.
        starts = np.zeros(len(data) + 1, dtype=bool)
        starts[offsets[:-1]] = True
        begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | starts[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | starts[1:])) + 1
        ends = np.concatenate([[0], np.cumsum(end - begin)])
        held = _LOWER[data[inside[1:-1]]]
        words = pa.LargeStringArray.from_buffers(
            len(begin), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(held))
        coded = words.dictionary_encode()
        self.distinct = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.texts = np.searchsorted(offsets, begin, "right") - 1
        breaks = np.concatenate([[0], np.cumsum(kind == 2)])[begin]
        self.fresh = np.ones(len(begin), dtype=bool)
        self.fresh[1:] = (np.diff(breaks) > 0) | (np.diff(self.texts) > 0)

    def by_language(self, languages: pa.Array) -> Iterator[tuple[str, np.ndarray]]:
        """Each language with the places of its words."""
        coded = languages.dictionary_encode()
        own = coded.indices.to_numpy(zero_copy_only=False)[self.texts] if len(languages) else (
            np.zeros(0, np.int64))
        for code, name in enumerate(coded.dictionary.to_pylist()):
            at = np.flatnonzero(own == code)
            if len(at):
                yield name, at


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, count) of ``texts`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                words = Words(batch.column(1))
                for language, at in words.by_language(batch.column(0)):
                    counts = np.bincount(words.codes[at], minlength=len(words.distinct))
                    used = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([language] * len(used), pa.string()),
                         words.distinct.take(pa.array(used)).cast(pa.string()),
                         pa.array(counts[used], pa.int64())], names=["lang", "word", "count"])

    return texts.mapInArrow(run, "lang string, word string, count long").groupBy(
        "lang", "word").agg(F.sum("count").alias("count"))


def _runs(numbers: np.ndarray) -> pa.Array:
    """Numbers without repeated 0, in rows that end at a 0."""
    keep = numbers != 0
    keep[1:] |= numbers[:-1] != 0
    numbers = numbers[keep]
    zeros = np.flatnonzero(numbers == 0)
    at = np.searchsorted(zeros, np.arange(ROW_NUMBERS, len(numbers), ROW_NUMBERS))
    cuts = np.unique(np.concatenate(
        [[0], zeros[at[at < len(zeros)]] + 1, [len(numbers)]])).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), max(len(cuts) - 1, 0), [
        None, pa.py_buffer(cuts * 4), pa.py_buffer(numbers.astype("<i4"))]).cast(pa.binary())


def numbered_texts(texts: DataFrame, symbols: DataFrame, scratch: Scratch) -> DataFrame:
    """(numbers): the texts as symbols (lang, word, symbol), 0 between what does not join."""
    sized = F.octet_length("word") + F.octet_length("lang") + 16
    size = symbols.agg(F.sum(sized).alias("bytes")).first()["bytes"] or 0
    blocks = int(size // BLOCK_BYTES) + 1
    frame = texts.withColumn("numbers", F.lit(None).cast("binary"))
    for k in range(blocks):
        rows = symbols.where(F.pmod(F.xxhash64("lang", "word"), F.lit(blocks)) == k).select(
            "lang", "word", "symbol").toArrow()
        known = {}
        for language in pc.unique(rows.column("lang")).to_pylist():
            own = rows.filter(pc.equal(rows.column("lang"), language))
            known[language] = (own.column("word").combine_chunks().cast(pa.large_string()),
                               own.column("symbol").to_numpy().astype(np.int32))
        shared = texts.sparkSession.sparkContext.broadcast(known)
        last = k == blocks - 1
        kept = "numbers binary" if last else "lang string, text string, numbers binary"
        frame = scratch.keep(frame.mapInArrow(_numbering(shared, k == 0, last), kept), "numbers")
    return frame


def _numbering(shared, first: bool, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                words = Words(batch.column(1))
                numbers = np.zeros(len(words.codes), dtype=np.int32)
                if not first:
                    numbers |= np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i4")
                for language, at in words.by_language(batch.column(0)):
                    if language not in shared.value:
                        continue
                    vocabulary, symbols = shared.value[language]
                    found = pc.index_in(words.distinct, value_set=vocabulary)
                    places = found.fill_null(-1).to_numpy(zero_copy_only=False)
                    mine = np.where(places >= 0, symbols[places], 0)[words.codes[at]]
                    numbers[at] |= mine
                if last:
                    spread = np.zeros(len(numbers) + int(words.fresh.sum()) + 1, dtype=np.int32)
                    spread[np.arange(len(numbers)) + np.cumsum(words.fresh)] = numbers
                    yield pa.RecordBatch.from_arrays([_runs(spread)], names=["numbers"])
                else:
                    ends = np.searchsorted(words.texts, np.arange(batch.num_rows + 1))
                    parts = [numbers[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(parts, pa.binary())],
                        names=["lang", "text", "numbers"])

    return run


class DoubleArray:
    """A trie of number sequences in two arrays.

    State ``s`` goes on number ``c`` to ``base[s] + c`` if ``check`` there is ``s``; the
    root is 0. ``name`` has the id of the sequence that a state accepts, or -1. Numbers are
    first replaced by their places in ``alphabet``, so the arrays are bounded by the trie.
    """

    def __init__(self, paths: list[np.ndarray], names: np.ndarray):
        lengths = np.array([len(p) for p in paths], dtype=np.int64)
        flat = np.concatenate(paths) if paths else np.zeros(0, np.int32)
        self.alphabet = np.unique(flat).astype(np.int32)
        self.longest = int(lengths.max(initial=0))
        size = len(self.alphabet)
        table = np.zeros((len(paths), self.longest), dtype=np.int64)
        table[np.arange(self.longest) < lengths[:, None]] = np.searchsorted(
            self.alphabet, flat) + 1
        self.base = np.zeros(size + 1, dtype=np.int64)
        self.check = np.full(size + 1, -1, dtype=np.int64)
        self._free = size + 1
        at = np.zeros(len(paths), dtype=np.int64)
        for depth in range(self.longest):
            live = np.flatnonzero(lengths > depth)
            edges, which = np.unique(at[live] * (size + 1) + table[live, depth],
                                     return_inverse=True)
            slots = self._placed(edges // (size + 1), edges % (size + 1), size)
            at[live] = slots[which]
        # Every step from every state stays inside the arrays.
        self._grow(int(self.base.max(initial=0)) + size + 2)
        self.name = np.full(len(self.base), -1, dtype=np.int64)
        self.name[at] = names
        self.base, self.check = self.base.astype(np.int32), self.check.astype(np.int32)

    def _grow(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _placed(self, parents: np.ndarray, numbers: np.ndarray, size: int) -> np.ndarray:
        """Slots of the edges (parent, number), sorted by both."""
        if len(parents) and parents[0] == 0:
            self.check[numbers] = 0
            return numbers
        slots = np.zeros(len(parents), dtype=np.int64)
        begins = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        ends = np.concatenate([begins[1:], [len(parents)]])
        families = np.argsort(begins - ends, kind="stable")
        large = int((ends - begins > 1).sum())
        for k in families[:large]:
            own = numbers[begins[k]:ends[k]]
            base = self._fitting(own)
            slots[begins[k]:ends[k]] = base + own
            self.base[parents[begins[k]]] = base
            self.check[base + own] = parents[begins[k]]
        # Lone children go anywhere.
        alone = begins[families[large:]]
        self._grow(self._free + size + 1)
        spare = np.flatnonzero(self.check[self._free:] < 0)
        if len(spare) < len(alone):
            before = len(self.check)
            self._grow(before + len(alone))
            spare = np.flatnonzero(self.check[self._free:] < 0)
        spots = spare[:len(alone)] + self._free
        slots[alone] = spots
        self.base[parents[alone]] = spots - numbers[alone]
        self.check[spots] = parents[alone]
        return slots

    def _fitting(self, own: np.ndarray) -> int:
        """The first base at which all of ``own`` is free."""
        at, step = self._free, 64
        while True:
            self._grow(at + step + int(own[-1]) + 1)
            spots = at + np.flatnonzero(self.check[at:at + step] < 0)
            free = np.ones(len(spots), dtype=bool)
            # Few bases pass the first members, so the rest is tried on few.
            for number in own[1:]:
                free[free] = self.check[spots[free] - own[0] + number] < 0
                if not free.any():
                    break
            if free.any():
                found = int(spots[np.argmax(free)])
                used = np.flatnonzero(self.check[self._free:found] < 0)
                # Long searches leave the crowded front to lone children.
                if len(used) > 4096:
                    self._free = self._free + int(used[len(used) // 2])
                return found - int(own[0])
            at, step = at + step, min(2 * step, 1 << 16)

    def symbols(self, numbers: np.ndarray) -> np.ndarray:
        """Numbers as places in the alphabet from 1, 0 where they are not in it."""
        if not len(self.alphabet):
            return np.zeros(len(numbers), dtype=np.int64)
        at = np.searchsorted(self.alphabet, numbers)
        at[at == len(self.alphabet)] = 0
        return np.where(self.alphabet[at] == numbers, at + 1, 0)

    def walk(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1, 2, ... words: the positions that the trie still follows, and their states."""
        symbols = np.concatenate([self.symbols(numbers), [0]])
        at = np.flatnonzero(symbols)
        states = symbols[at]
        live = self.check[states] == 0
        at, states = at[live], states[live]
        for depth in range(1, self.longest + 1):
            yield at, states
            following = symbols[at + depth]
            states_next = self.base[states] + following
            live = (following > 0) & (self.check[states_next] == states)
            at, states = at[live], states_next[live]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Stored rows of numbers, many at a time, each followed by a 0."""
    parts, size = [], 0
    for batch in batches:
        for value in batch.column(0):
            part = np.frombuffer(value.as_buffer(), "<i4")
            parts.append(part)
            size += len(part)
            if size >= WALK_NUMBERS:
                yield np.concatenate(parts)
                parts, size = [], 0
    if parts:
        yield np.concatenate(parts)


def tries(phrases: DataFrame) -> Iterator[tuple[DoubleArray, bool]]:
    """Tries of stored ``phrases`` (id, path), a shard at a time, and whether it is the only one."""
    shards = phrases.count() // SHARD_PHRASES + 1
    for k in range(shards):
        rows = phrases.where(F.pmod(F.xxhash64("path"), F.lit(shards)) == k).select(
            "id", "path").toArrow()
        lists = rows.column("path").combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        yield DoubleArray(np.split(flat, ends[:-1]) if len(ends) else [],
                          rows.column("id").to_numpy()), shards == 1


class Tally:
    """Sums by key that stay within ``TALLY_KEYS`` keys: ``add`` yields what is full."""

    def __init__(self):
        self.keys, self.seen, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.keys.append(keys)
        self.seen.append(np.ones(len(keys), dtype=np.int64))
        self.size += len(keys)
        if self.size > TALLY_KEYS:
            keys, seen = self._combined()
            # Full of distinct keys, it starts anew.
            if len(keys) > TALLY_KEYS // 2:
                yield keys, seen
                keys, seen = keys[:0], seen[:0]
            self.keys, self.seen, self.size = [keys], [seen], len(keys)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.size:
            yield self._combined()

    def _combined(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        keys, seen = keys[order], np.concatenate(self.seen)[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
        return keys[first], np.add.reduceat(seen, first) if len(first) else seen


def extensions(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """(id, symbol, seen): what follows phrases of one length, if it can be frequent."""

    def follower(shared, only: bool, longest: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie, tally = shared.value, Tally()

            def rows(keys: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(trie.name[keys >> 32], pa.int64()),
                     pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(seen)],
                    names=["id", "symbol", "seen"])

            for numbers in _gathered(batches):
                for at, states in trie.walk(numbers):
                    pass
                # Rows end in 0, so something follows every place.
                following = numbers[at + longest]
                able = following > 0
                if only:
                    accepted = np.zeros(len(numbers) + 1, dtype=bool)
                    accepted[at] = True
                    able &= accepted[at + 1]
                for full in tally.add((states[able].astype(np.int64) << 32) | following[able]):
                    yield rows(*full)
            for full in tally.rest():
                yield rows(*full)

        return run

    frames = []
    for trie, only in tries(phrases):
        if trie.longest:
            shared = texts.sparkSession.sparkContext.broadcast(trie)
            frames.append(texts.mapInArrow(follower(shared, only, trie.longest),
                                           "id long, symbol int, seen long"))
    return reduce(DataFrame.union, frames).groupBy("id", "symbol").agg(F.sum("seen").alias("seen"))


def trie_counts(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """(id, seen): how often each phrase occurs in the texts."""

    def counter(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie = shared.value
            sums = np.zeros(len(trie.name), dtype=np.int64)
            for numbers in _gathered(batches):
                for _, states in trie.walk(numbers):
                    sums += np.bincount(states, minlength=len(sums))
            # A page of sums is a row, whatever the number of phrases in it.
            pages = [(k, sums[at:at + PAGE].tobytes()) for k, at in enumerate(
                range(0, len(sums), PAGE)) if sums[at:at + PAGE].any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in pages], pa.int32()),
                 pa.array([x for _, x in pages], pa.binary())], names=["page", "sums"])

        return run

    def adder(shared):
        def run(table: pa.Table) -> pa.Table:
            names = shared.value.name[table.column("page")[0].as_py() * PAGE:][:PAGE]
            total = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("sums"))
            used = np.flatnonzero((total > 0) & (names >= 0))
            return pa.table({"id": pa.array(names[used]), "seen": pa.array(total[used])})

        return run

    frames = []
    for trie, _ in tries(phrases):
        shared = texts.sparkSession.sparkContext.broadcast(trie)
        frames.append(texts.mapInArrow(counter(shared), "page int, sums binary").groupBy(
            "page").applyInArrow(adder(shared), "id long, seen long"))
    return reduce(DataFrame.union, frames)


def frequent_phrases(texts: DataFrame, symbols: DataFrame, longest: int, min_count: int,
                     scratch: Scratch) -> DataFrame:
    """(id, lang, phrase, path, a) of the frequent phrases of 1 to ``longest`` words."""
    words = symbols.select("symbol", "word")
    level = symbols.select(F.col("symbol").cast("long").alias("id"), "lang",
                           F.col("word").alias("phrase"), F.array("symbol").alias("path"))
    levels = [scratch.keep(level, "phrases-1")]
    for length in range(2, longest + 1):
        if levels[-1].isEmpty():
            break
        grown = scratch.keep(extensions(texts, levels[-1]).where(
            F.col("seen") >= min_count).select("id", "symbol"), "extensions")
        # A word may extend very many phrases, but each only once.
        longer = grown.join(levels[-1], "id").join(
            bounded_broadcast(words, BROADCAST_BYTES), "symbol").select(
            "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"),
            F.concat("path", F.array("symbol")).alias("path"))
        levels.append(scratch.keep(longer.select(
            (F.lit(length << 58) + F.monotonically_increasing_id()).alias("id"), "lang", "phrase",
            "path"), f"phrases-{length}"))
    phrases = scratch.keep(reduce(DataFrame.union, levels), "phrases")
    counts = scratch.keep(trie_counts(texts, phrases), "counts")
    return scratch.keep(phrases.join(counts.select("id", F.col("seen").alias("a")), "id").where(
        F.col("a") >= min_count), "counted")


def scored(phrases: DataFrame, totals: DataFrame, absorbed: int = ABSORBED) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one replaces."""
    words = F.size("path")
    candidates = phrases.where(words > 1)
    cuts = candidates.select("id", "lang", "phrase", "path", "a", F.explode(F.sequence(
        F.lit(1), words - 1)).alias("k")).select(
        "id", "lang", "phrase", "path", "a", "k", F.slice("path", F.lit(1), F.col("k")).alias("first"),
        F.slice("path", F.col("k") + 1, words - F.col("k")).alias("rest"))
    counts = phrases.select("path", "a")
    of_first = counts.select(F.col("path").alias("first"), F.col("a").alias("l"))
    of_rest = counts.select(F.col("path").alias("rest"), F.col("a").alias("r"))

    def exact(name: str) -> str:
        return f"CAST({name} AS DECIMAL(19, 0))"

    score = F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * {exact('a')} * {exact('n')}) "
                   f"div ({exact('l')} * {exact('r')})")
    weakest = cuts.join(of_first, "first").join(of_rest, "rest").join(
        bounded_broadcast(totals, BROADCAST_BYTES), "lang").withColumn("score", score).groupBy(
        "id", "lang", "phrase", "path", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.array(F.slice("path", F.lit(1), words - 1), F.slice("path", F.lit(2), words - 1))
    within = candidates.where(words > 2).select(F.explode(inner).alias("path"), "a").groupBy(
        "path").agg(F.max("a").alias("longer"))
    return weakest.join(within, "path", "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a"))).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def best(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` of each language with their rank, cut in deals first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = candidates.withColumn("_deal", F.pmod(F.xxhash64("phrase"), F.lit(DEALS)))
    for group in (["lang", "_deal"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(
            Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= top)
    return rows.drop("_deal")


def collocations(docs: DataFrame, text: str = "text", language: str = "lang",
                 longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's strongest collocations."""
    scratch = Scratch(docs.sparkSession, "collocations")
    texts = docs.select(F.coalesce(F.col(language).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.col(text).alias("text")).where(F.length("text") > 0)
    words = scratch.keep(word_counts(texts), "words")
    totals = scratch.keep(words.groupBy("lang").agg(F.sum("count").alias("n")), "totals")
    frequent = scratch.keep(words.where(F.col("count") >= min_count).select(
        F.lit(0).alias("every"), (-F.col("count")).alias("rare"), "lang", "word"), "frequent")
    symbols = scratch.keep(ranked(frequent, "every", ["rare", "lang", "word"], scratch).select(
        "lang", "word", (F.col("rank") + 1).cast("int").alias("symbol")), "symbols")
    numbers = numbered_texts(texts, symbols, scratch)
    phrases = frequent_phrases(numbers, symbols, longest, min_count, scratch)
    result = materialized(best(scored(phrases, totals), top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"),
        "collocations")
    scratch.close()
    return result
