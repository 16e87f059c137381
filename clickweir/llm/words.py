"""Words of Arrow text columns as 64-bit hashes, a batch at a time.

A word is a maximal run of bytes other than ASCII white space, after A-Z are
lower-cased. Hashes are polynomials over the bytes; they are the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes that are hashed together; bounds the helper arrays.
CHUNK = 1 << 19
# Texts are handled in slices of about so many bytes, or one longer text.
SLICE_BYTES = 4 * 1024 * 1024
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_VALUES[ord("A"):ord("Z") + 1] = _VALUES[ord("a"):ord("z") + 1]


def _powers(of: np.uint64, n: int) -> np.ndarray:
    factors = np.full(n, of, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_POWERS = {"up": _powers(_BASE, CHUNK), "down": _powers(_INVERSE, CHUNK)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= CHUNK:
        return _POWERS["up"], _POWERS["down"]
    return _powers(_BASE, n), _powers(_INVERSE, n)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[
        column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else (
        np.zeros(1, np.int64))
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held, offsets


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE_BYTES`` of text each."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _cuts(data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``CHUNK`` bytes that end where no word goes on."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + CHUNK, end)
        step = 256
        while to < end:
            border = int(offsets[np.searchsorted(offsets, to)])
            free = np.flatnonzero(spaces[data[to:to + step]])
            reach = to + int(free[0]) if len(free) else end + 1
            if min(reach, border) <= min(to + step, end):
                to = min(reach, border)
                break
            to += step
            step *= 2
        to = min(to, end)
        yield at, to
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray,
                spaces: np.ndarray = _SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each text the number of words before it (one more at the end).

    ``spaces`` marks the bytes that separate words.
    """
    hashes, starts = [], []
    doc_starts = offsets[:-1][np.diff(offsets) > 0]
    for lo, hi in _cuts(data, offsets, spaces):
        part = data[lo:hi]
        word = ~spaces[part]
        first = np.zeros(hi - lo + 1, dtype=bool)
        first[doc_starts[np.searchsorted(doc_starts, lo):np.searchsorted(doc_starts, hi)] - lo] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | first[1:-1]
        ends = word
        ends[:-1] &= ~word[1:] | first[1:-1]
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends)
        up, down = _power_tables(hi - lo)
        total = np.cumsum(_VALUES[part] * up[:hi - lo], dtype=np.uint64)
        sums = total[end] - np.where(begin > 0, total[begin - 1], np.uint64(0))
        hashes.append(mixed(sums * down[begin] + (end - begin).astype(np.uint64) * _BASE))
        starts.append(begin + lo)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[
        np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and the bounds of each text's runs.

    A text with fewer words has one run, all of it; a text without words has none.
    """
    n = np.diff(bounds)
    runs = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    ends = np.concatenate([[0], np.cumsum(runs)])
    at = np.repeat(bounds[:-1] - ends[:-1], runs) + np.arange(ends[-1])
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    powers = _powers(_INVERSE, size + 1)
    rolled = np.zeros(len(words), dtype=np.uint64)
    for k in range(size):
        rolled += padded[k:k + len(words)] * powers[k]
    out = mixed(rolled[at])
    for doc in np.flatnonzero((n > 0) & (n < size)):
        lo, hi = bounds[doc], bounds[doc + 1]
        short = (words[lo:hi] * powers[:hi - lo]).sum(dtype=np.uint64)
        out[ends[doc]] = mixed(np.array([short + np.uint64(hi - lo)]))[0]
    return out, ends


def distinct_sorted(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text in ascending order, and their bounds."""
    parts = [np.unique(values[lo:hi]) for lo, hi in zip(bounds[:-1], bounds[1:])]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    joined = np.concatenate(parts) if parts else values[:0]
    return joined, np.concatenate([[0], np.cumsum(sizes)])
