"""BPE encoding and decoding through a pair occurrence index.

The distinct new words of a batch are laid out as one row of symbols. An index maps
each mergeable pair to all its positions; the active ranks are applied in ascending
order, each to all positions of its pair at once, and the positions of the pairs that a
merge makes are added to their lists. Words are independent, so this gives each word
the merges it would get alone.

The model file follows the ``tokenizers`` library: NFC, lower case, a pattern that picks
words, bytes as characters, a mark at word ends. Strings of special tokens in a text
become their ids, and decoding joins tokens by blanks, as the file has no decoder.

Defined results: a null or empty text has no tokens and decodes to the empty text; null
ids decode like empty ones; rows are encoded one by one, so repeated rows agree and all
other columns pass through, except that a column of the result's name gives way.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Encoded words that a task remembers; beyond that it forgets all and starts again.
REMEMBERED_WORDS = 200_000
# Texts of about so many characters are encoded together.
SLICE_CHARS = 1_000_000
# Longer position lists are merged as arrays.
ARRAY_MERGE = 24


def byte_characters() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@dataclass(frozen=True)
class BpeModel:
    """What a model file holds; a few MB, whatever the size of the corpus."""

    tokens: list[str]
    pairs: dict[int, tuple[int, int]]  # left * 2^20 + right -> (rank, merged id)
    first: list[int]  # id of each byte inside a word
    last: list[int]  # id of each byte at a word's end
    special: dict[str, int]
    pattern: str


def load_model(path: str) -> BpeModel:
    """Read a word-level BPE file on the driver; tasks get it by broadcast."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, end = data["model"], data["model"]["end_of_word_suffix"]
    vocab = dict(model["vocab"])
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    tokens = [""] * size
    for token, i in [*vocab.items(), *special.items()]:
        tokens[i] = token
    pairs = {}
    for rank, (left, right) in enumerate(model["merges"]):
        pairs.setdefault(vocab[left] << 20 | vocab[right], (rank, vocab[left + right]))
    characters = byte_characters()
    splits = [p["pattern"]["Regex"] for p in data["pre_tokenizer"]["pretokenizers"]
              if p["type"] == "Split"]
    return BpeModel(tokens, pairs, [vocab[c] for c in characters],
                    [vocab[c + end] for c in characters], special,
                    splits[0].replace(r"\s", r"\p{White_Space}"))


class PairIndex:
    """Merges the pairs of many words at once."""

    def __init__(self, model: BpeModel):
        self.model = model
        by_rank = sorted((rank, key, merged) for key, (rank, merged) in model.pairs.items())
        self.of_rank = {rank: (key >> 20, key & 0xFFFFF, merged) for rank, key, merged in by_rank}
        self.keys = np.array(sorted(model.pairs), dtype=np.int64)
        self.ranks = np.array([model.pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair does not merge."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        # Symbols with a gap of -1 before and after each word.
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", dtype=np.uint8)
        gaps = np.concatenate([[0], np.cumsum(lengths + 1)])
        sym = np.array(self.model.first, dtype=np.int32)[data]
        ends = gaps[1:] - 1
        sym[ends] = np.array(self.model.last, dtype=np.int32)[data[ends]]
        sym[gaps] = -1
        nxt = np.arange(1, len(sym) + 1, dtype=np.int32)
        prv = np.arange(-1, len(sym) - 1, dtype=np.int32)
        lists: dict[int, list] = {}
        active: list[int] = []

        def add(ranks: np.ndarray, positions: np.ndarray) -> None:
            found = np.flatnonzero(ranks >= 0)
            if not len(found):
                return
            ranks, positions = ranks[found], positions[found]
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(),
                                  np.split(positions, cuts)):
                if rank not in lists:
                    lists[rank] = []
                    heapq.heappush(active, rank)
                lists[rank] += part.tolist() if len(part) < ARRAY_MERGE else [part]

        add(self._ranks_of(sym[:-1], sym[1:]), np.arange(len(sym) - 1))
        pairs = self.model.pairs
        while active:
            rank = heapq.heappop(active)
            parts = lists.pop(rank)
            left, right, merged = self.of_rank[rank]
            arrays = [p for p in parts if not isinstance(p, int)]
            at = np.concatenate([np.array([p for p in parts if isinstance(p, int)], np.int64),
                                 *arrays])
            if left == right or len(at) < ARRAY_MERGE:
                # One by one, from the left: a pair of equal symbols can overlap itself.
                for p in sorted(set(at.tolist())):
                    q = int(nxt[p])
                    if sym[p] != left or sym[q] != right:
                        continue
                    sym[p], sym[q] = merged, -2
                    after, before = int(nxt[q]), int(prv[p])
                    nxt[p], prv[after] = after, p
                    for a, b in ((before, p), (p, after)):
                        new = pairs.get(int(sym[a]) << 20 | int(sym[b])) if (
                            sym[a] >= 0 and sym[b] >= 0) else None
                        if new:
                            if new[0] not in lists:
                                lists[new[0]] = []
                                heapq.heappush(active, new[0])
                            lists[new[0]].append(a)
                continue
            at = np.unique(at)
            at = at[(sym[at] == left)]
            at = at[sym[nxt[at]] == right]
            if not len(at):
                continue
            gone = nxt[at]
            sym[at], sym[gone] = merged, -2
            after = nxt[gone]
            nxt[at], prv[after] = after, at
            before = prv[at]
            add(self._ranks_of(sym[before], sym[at]), before)
            add(self._ranks_of(sym[at], sym[after]), at)
        keep = sym >= 0
        counts = np.add.reduceat(keep.astype(np.int64), gaps[:-1]) if len(gaps) > 1 else keep[:0]
        return sym[keep], counts


class _Encoder:
    """Encodes texts, remembering the words of earlier ones."""

    def __init__(self, model: BpeModel):
        self.index = PairIndex(model)
        self.find = regex.compile(model.pattern).findall
        self.special = model.special
        self.split = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(model.special, key=len, reverse=True)) + ")").split
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.starts, self.sizes = (np.zeros(0, np.int32), np.zeros(0, np.int64),
                                             np.zeros(0, np.int64))
        # Special tokens are words of one token each, under numbers of their own.
        for s, i in self.special.items():
            self.number["\0" + s] = len(self.number)
            self._append(np.array([i], np.int32), np.array([1]))

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.ids = np.concatenate([self.ids, ids])
        self.sizes = np.concatenate([self.sizes, sizes])

    def _words(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # the file's lower case knows no final sigma
            text = text.replace("Σ", "σ")
        return self.find(text.lower())

    def _numbers(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        number = self.number
        pieces = self.split(text) if "<|" in text else [text]
        out = []
        for k, piece in enumerate(pieces):
            words = ["\0" + piece] if k % 2 else self._words(piece)
            out += [number.setdefault(w, len(number)) for w in words]
        return np.array(out, dtype=np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.number) > REMEMBERED_WORDS:
            self.forget()
        known = len(self.number)
        numbered = [self._numbers(t) for t in texts]
        new = list(self.number)[known:]
        self._append(*self.index.encode([w.encode("utf-8", "surrogatepass") for w in new]))
        out = []
        for n in numbered:
            sizes = self.sizes[n]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            at = np.repeat(self.starts[n] - ends + sizes, sizes) + np.arange(total)
            out.append(self.ids[at].astype("<u4").tobytes())
        return out


def _sliced(column: pa.Array) -> Iterator[list]:
    """The values in lists of about ``SLICE_CHARS`` bytes."""
    part, size = [], 0
    for value in column:
        value = value.as_py()
        part.append(value)
        size += len(value or "")
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    yield part


def _with_column(df: DataFrame, name: str, kind: T.DataType,
                 dropped: str | None = None) -> tuple[list[int], T.StructType]:
    kept = [i for i, c in enumerate(df.columns) if c not in (name, dropped)]
    return kept, T.StructType([*[df.schema[i] for i in kept], T.StructField(name, kind)])


def _cut(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """The parts of ``batch`` by ``_sliced`` values of column ``at``, which come with each part."""
    start = 0
    for part in _sliced(batch.column(at)):
        if part:
            yield batch.slice(start, len(part)), part
        start += len(part)


def _texts(model: BpeModel, packed: list[bytes | None]) -> list[str]:
    token = model.tokens.__getitem__
    return [" ".join(map(token, np.frombuffer(x or b"", "<u4").tolist())) for x in packed]


def encode(df: DataFrame, model: BpeModel, text: str = "text", ids: str = "ids",
           keep_text: bool = True) -> DataFrame:
    """``df`` with the token ids of its text, packed as little-endian 32-bit integers."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)
    kept, schema = _with_column(df, ids, T.BinaryType(), None if keep_text else text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(shared.value)
        for batch in batches:
            for part, values in _cut(batch, at):
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in kept],
                     pa.array(encoder.encode(values), pa.binary())], names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model: BpeModel, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its packed token ids; special tokens stay."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(ids)
    kept, schema = _with_column(df, text, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in _cut(batch, at):
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in kept],
                     pa.array(_texts(shared.value, values), pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, model: BpeModel, text: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` without the text, in one pass through one Python worker a task.

    Two passes run at once, each in a worker that holds the model and batches of its own.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text)
    kept = [i for i, c in enumerate(df.columns) if c not in (text, ids, decoded)]
    schema = T.StructType([*[df.schema[i] for i in kept], T.StructField(ids, T.BinaryType()),
                           T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(shared.value)
        for batch in batches:
            for part, values in _cut(batch, at):
                packed = encoder.encode(values)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in kept], pa.array(packed, pa.binary()),
                     pa.array(_texts(shared.value, packed), pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
