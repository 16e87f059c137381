"""Benchmark decontamination by greedy string tiling.

Texts and test items are sequences of lower-cased runs of letters and digits. Running
Karp-Rabin hashes of ``MIN_MATCH`` tokens are seeds; a document meets the items whose
seeds it has. For each such pair the seeds on one diagonal join into maximal matches,
and again and again the longest match that overlaps no tile yet becomes a tile (of equal
ones the first in the item, then in the document). The share of the item under tiles is
its coverage, whatever the order of its passages in the document.

A pair of texts that repeat themselves shares more seeds than its texts are long. There
the longest match is found without listing seeds: running Karp-Rabin hashes of windows
of one length tell whether any match is that long, and halving finds the longest length.
All its tiles are taken before the next length, which gives the same tiles in memory
that grows with the two texts only.

The items are the query set: they are collected and broadcast in blocks of bounded size,
and each block is one pass over the documents, which are never shuffled.

Defined results: null and empty texts have no tokens and no matches, nor have items of
fewer than ``MIN_MATCH`` tokens. Rows are judged one by one, so repeated rows get equal
answers. Without items nothing is contaminated. Ids may have any simple type. Where both
ids have one name, the item's gets ``item_`` in front.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickweir.llm.words import shingle_hashes, text_bytes, word_hashes

MIN_MATCH = 5
# A document is contaminated by an item of which at least this share lies under tiles.
COVERAGE = 0.5
# Text of the items that are broadcast at once.
BLOCK_BYTES = 16 * 1024 * 1024
_SLICE_ROWS = 1000
# Beyond this many common seeds per token of the two texts they are not listed.
SEEDS_PER_TOKEN = 4
# Moduli and bases of the window hashes; products stay within 64 bits.
_PRIMES = ((2147483647, 1000003), (2147483629, 998244))

# Of the ASCII characters only letters and digits belong to tokens.
_BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*text_bytes(pc.utf8_lower(column)), spaces=_BREAKS)


def _seeds(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed hashes with their text and the place of their first token in it."""
    hashes, ends = shingle_hashes(tokens, bounds, MIN_MATCH)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(ends))
    place = np.arange(len(hashes)) - ends[text]
    whole = np.diff(bounds)[text] >= MIN_MATCH
    return hashes[whole], text[whole], place[whole]


@dataclass(frozen=True)
class Items:
    """A block of items, ready to be searched: sorted seeds and where they occur."""

    ids: list
    tokens: np.ndarray
    bounds: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray


def prepared(ids: list, texts: list[str | None]) -> Items:
    tokens, bounds = _tokens(pa.array(texts, pa.string()))
    hashes, item, place = _seeds(tokens, bounds)
    order = np.argsort(hashes, kind="stable")
    return Items(ids, tokens, bounds, np.diff(bounds), hashes[order], item[order], place[order])


def tiles(place: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """Tiles (in the item, in the document, length) of one pair from its common seeds."""
    order = np.lexsort((place, at - place))
    p, t = place[order], at[order]
    breaks = np.flatnonzero((np.diff(t - p) != 0) | (np.diff(p) != 1)) + 1
    begins = np.concatenate([[0], breaks])
    lengths = np.diff(np.concatenate([begins, [len(p)]])) + MIN_MATCH - 1
    waiting = list(zip((-lengths).tolist(), p[begins].tolist(), t[begins].tolist()))
    heapq.heapify(waiting)
    item_marks, doc_marks = set(), set()
    found = []
    while waiting:
        length, i, j = heapq.heappop(waiting)
        free = [k for k in range(-length)
                if i + k not in item_marks and j + k not in doc_marks]
        if len(free) == -length:
            found.append((i, j, -length))
            item_marks.update(range(i, i - length))
            doc_marks.update(range(j, j - length))
            continue
        # What tiles have left of the match waits on, if it is long enough.
        start = 0
        for k in range(1, len(free) + 1):
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - start >= MIN_MATCH:
                    heapq.heappush(waiting, (start - k, i + free[start], j + free[start]))
                start = k
    return found


def _window_hashes(tokens: np.ndarray) -> Callable[[np.ndarray, int], np.ndarray]:
    """Hashes of windows, by start and length, from running sums made once."""
    sums, powers = [], []
    for prime, base in _PRIMES:
        power = np.ones(1, dtype=np.uint64)
        while len(power) <= len(tokens):
            factor = np.uint64(int(power[-1]) * base % prime)
            power = np.concatenate([power, power * factor % np.uint64(prime)])
        powers.append(power)
        # A sum of 2^32 residues of 31 bits fits.
        part = np.cumsum(tokens * power[:len(tokens)] % np.uint64(prime), dtype=np.uint64)
        sums.append(np.concatenate([np.zeros(1, np.uint64), part % np.uint64(prime)]))

    def hashes(at: np.ndarray, length: int) -> np.ndarray:
        found = np.zeros(len(at), dtype=np.uint64)
        for (prime, _), total, power in zip(_PRIMES, sums, powers):
            p = np.uint64(prime)
            value = (total[at + length] + p - total[at]) % p
            # Shifted to one exponent, so that equal windows agree wherever they are.
            found = (found << np.uint64(32)) | value * power[len(tokens) - at] % p
        return found

    return hashes


def tiles_by_length(item: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int]]:
    """The same tiles as ``tiles``, from the tokens of the item and of the document."""
    # Tokens are numbered, from 1 so that none is neutral.
    _, numbers = np.unique(np.concatenate([item, doc]), return_inverse=True)
    hashes = _window_hashes(numbers.astype(np.uint64) + np.uint64(1))
    n = len(item)
    # Tokens under tiles; item and document lie in one row, and no window spans both.
    marks = np.zeros(len(numbers), dtype=bool)
    found: list[tuple[int, int, int]] = []

    def free(length: int) -> tuple[np.ndarray, np.ndarray]:
        taken = np.concatenate([[0], np.cumsum(marks)])
        at = np.flatnonzero(taken[length:] == taken[:len(taken) - length])
        return at[at <= n - length], at[at >= n]

    def common(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and hashes of the free windows that both sides have."""
        mine, theirs = free(length)
        a, b = hashes(mine, length), hashes(theirs, length)
        x, y = np.isin(a, b), np.isin(b, a)
        return mine[x], a[x], theirs[y], b[y]

    top = min(n, len(doc))
    while top >= MIN_MATCH and len(common(MIN_MATCH)[0]):
        low, high = MIN_MATCH, top
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if len(common(middle)[0]) else (low, middle - 1)
        mine, a, theirs, b = common(low)
        order = np.argsort(b, kind="stable")
        theirs, b = theirs[order], b[order]
        # Tiles so far are at least this long: one that meets a window covers an end of it.
        places = np.searchsorted(b, a)
        ends = np.searchsorted(b, a, "right")
        used: dict[int, int] = {}
        for i, place, end in zip(mine.tolist(), places.tolist(), ends.tolist()):
            if marks[i] or marks[i + low - 1]:
                continue
            k = used.get(place, place)
            while k < end and (marks[theirs[k]] or marks[theirs[k] + low - 1]):
                k += 1
            used[place] = k
            if k < end:
                j = int(theirs[k])
                marks[i:i + low] = marks[j:j + low] = True
                found.append((i, j - n, low))
        top = low - 1
    return found


def _matches(column: pa.Array, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, tiles, tokens under tiles) of the pairs with common seeds."""
    tokens, bounds = _tokens(column)
    hashes, row, at = _seeds(tokens, bounds)
    if not len(items.hashes) or not len(hashes):
        return
    low = np.searchsorted(items.hashes, hashes)
    hit = np.flatnonzero(items.hashes[np.minimum(low, len(items.hashes) - 1)] == hashes)
    low, row, at = low[hit], row[hit], at[hit]
    high = np.searchsorted(items.hashes, hashes[hit], "right")
    cuts = np.flatnonzero(np.diff(row)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(row)]):
        if lo < hi:
            doc = tokens[bounds[row[lo]]:bounds[row[lo] + 1]]
            for item, found in _tiled(doc, at[lo:hi], low[lo:hi], high[lo:hi], items):
                yield int(row[lo]), item, len(found), sum(length for _, _, length in found)


def _tiled(doc: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, items: Items
           ) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """(item, tiles) for one document, whose seed at ``at`` is in ``items`` at low to high."""
    # A seed that the document has often is looked at once.
    first, often = np.unique(low, return_counts=True)
    n = high[np.unique(low, return_index=True)[1]] - first
    seed = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    item, pairs = items.item[seed], np.repeat(often, n)
    members, inverse = np.unique(item, return_inverse=True)
    pairs = np.bincount(inverse, weights=pairs)
    listed = pairs <= SEEDS_PER_TOKEN * (len(doc) + items.lengths[members])
    by_item, by_seed = np.argsort(inverse, kind="stable"), np.argsort(low, kind="stable")
    ends = np.cumsum(np.bincount(inverse))
    for k, member in enumerate(members.tolist()):
        if not listed[k]:
            own = items.tokens[items.bounds[member]:items.bounds[member + 1]]
            yield member, tiles_by_length(own, doc)
            continue
        mine = by_item[(ends[k - 1] if k else 0):ends[k]]
        start = np.repeat(first, n)[mine]
        begin = np.searchsorted(low[by_seed], start)
        times = np.searchsorted(low[by_seed], start, "right") - begin
        which = np.repeat(begin - np.cumsum(times) + times, times) + np.arange(times.sum())
        yield member, tiles(np.repeat(items.place[seed[mine]], times), at[by_seed[which]])


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Items]:
    """The items in blocks of about ``BLOCK_BYTES``; each is collected on its own."""
    chosen = items.select(F.col(item_id).alias("id"), F.col(text).alias("text"))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for block in range(n):
        rows = chosen.where(
            F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block).collect()
        yield prepared([r["id"] for r in rows], [r["text"] for r in rows])


def tiled(docs: DataFrame, items: DataFrame, id_: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row per document and item with a tile: ids, n_tiles, n_matched, item_tokens, coverage."""
    item_type = items.schema[item_id].dataType
    kinds = docs.schema[id_].dataType.simpleString(), item_type.simpleString()
    arrow_type = to_arrow_type(item_type)
    schema = (f"doc {kinds[0]}, item {kinds[1]}, n_tiles long, n_matched long, "
              "item_tokens long, coverage double")
    passes = []
    for block in _blocks(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for whole in batches:
                for start in range(0, whole.num_rows, _SLICE_ROWS):
                    batch = whole.slice(start, _SLICE_ROWS)
                    found = list(_matches(batch.column(1), known))
                    lengths = [int(known.lengths[m[1]]) for m in found]
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array([m[0] for m in found], pa.int64())),
                        pa.array([known.ids[m[1]] for m in found], arrow_type),
                        pa.array([m[2] for m in found], pa.int64()),
                        pa.array([m[3] for m in found], pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array([m[3] / n for m, n in zip(found, lengths)], pa.float64()),
                    ], names=["doc", "item", "n_tiles", "n_matched", "item_tokens", "coverage"])

        passes.append(docs.select(id_, text).mapInArrow(run, schema))
    result = passes[0]
    for more in passes[1:]:
        result = result.unionByName(more)
    return result.withColumnsRenamed(
        {"doc": id_, "item": f"item_{item_id}" if item_id == id_ else item_id})


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text",
                   item_id: str = "item_id", item_text: str = "text",
                   coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that no item covers to ``coverage`` or more."""
    at = docs.columns.index(text)
    for block in _blocks(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for whole in batches:
                for start in range(0, whole.num_rows, _SLICE_ROWS):
                    batch = whole.slice(start, _SLICE_ROWS)
                    clean = np.ones(batch.num_rows, dtype=bool)
                    for row, item, _, matched in _matches(batch.column(at), known):
                        if matched >= coverage * known.lengths[item]:
                            clean[row] = False
                    yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
