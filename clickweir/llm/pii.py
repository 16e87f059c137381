"""Personal data by weak supervision: voting labelers, reliabilities, a span classifier.

Four strict patterns give base spans, which always stay. Everything else that a loose
pattern, a gazetteer of field names or a context labeler points at is a candidate. Each
labeler votes yes, no or not at all; expectation-maximisation over the vote patterns of
all candidates estimates how reliable each labeler is and how likely each pattern is
personal data. Those probabilities train a logistic classifier on the shape of a span
and its surroundings, and candidates that it accepts become spans.

Votes and features are few-valued, so what training needs is the number of candidates
of each combination: a table that is bounded whatever the size of the corpus, summed
over every document. No sample is taken.

Defined results: null and empty texts have no spans. Rows are scanned one by one, so
repeated rows get equal spans. Places are code points, ends exclusive. Without any
candidate the base spans alone are returned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
# Kinds that only the method finds, in their order in lists of spans.
MORE_KINDS = ("secret", "number", "handle")
KINDS = BASE_KINDS + MORE_KINDS
EM_ROUNDS = 200
ACCEPT = 0.5
# Characters before a candidate that the context labelers read.
CONTEXT = 40

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive, and started only where no digit goes before: the spans are the same as
# without, but a long run of digits is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_DIGIT = re.compile(r"[0-9]")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Names of fields that hold personal or secret values.
GAZETTEER = frozenset((
    "account address api apikey auth birthday card cell contact credential iban id key login "
    "mail mobile name passport passwd password phone pin pwd secret session ssn tel telephone "
    "token user username").split())
# Words that announce contact data.
ANNOUNCE = re.compile(
    r"(?i)\b(?:call|contact|reach|mail|write to|phone|tel|fax|email|mobile|signed|sent by|from)\b"
    r"[^\n]{0,12}$")
# Words before a number that make it a harmless one.
HARMLESS = re.compile(r"(?i)\b(?:version|page|chapter|section|figure|year|since|in|no|nr)\.? ?$")

_CANDIDATES = (
    # A value that is assigned to a name, or a long mixed run as keys are.
    ("secret", re.compile(r"""(?x)
        (?P<name>[A-Za-z_]{2,30}+) [ ]? [=:] [ ]? ["']? (?P<value>[A-Za-z0-9+/_-]{8,}+)""")),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_-])(?P<value>(?=[A-Z]{3}[A-Z]*[0-9])[A-Z0-9]{16,}+)"
                          r"(?![A-Za-z0-9+/_-])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9+/_-])(?P<value>(?=[0-9a-f]*[0-9])[0-9a-f]{16,}+)"
                          r"(?![A-Za-z0-9+/_-])")),
    # Grouped or long numbers that are none of the strict kinds.
    ("number", re.compile(r"(?<![A-Za-z0-9.-])(?P<value>[0-9]{2,6}(?:[ -][0-9]{2,6}){1,5}+"
                          r"|[0-9]{7,}+)(?![A-Za-z0-9-])")),
    ("handle", re.compile(r"(?<![A-Za-z0-9._%+@-])(?P<value>@[A-Za-z0-9_]{3,}+)(?![A-Za-z0-9@.])")),
)

LABELERS = ("pattern", "gazetteer", "announced", "harmless", "mixture")
FEATURES = ("bias", "secret", "number", "handle", "named", "long", "digits", "letters", "upper",
            "assigned", "grouped", "quoted")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the strict kinds, by kind and then by start."""
    found = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256
               for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() < 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    votes: tuple[int, ...]  # per labeler 1, 0 or -1: yes, no, abstains
    features: tuple[int, ...]  # per feature 0 or 1


def _judged(text: str, kind: str, start: int, end: int, name: str | None, sure: bool) -> Candidate:
    value, before = text[start:end], text[max(0, start - CONTEXT):start]
    digits = sum("0" <= c <= "9" for c in value)
    letters = sum(c.isalpha() for c in value)
    named = bool(name) and bool(GAZETTEER & set(re.split(r"[_\W]+", name.lower())))
    mixed = digits >= 4 and letters >= 3
    votes = (
        1 if sure else -1,
        1 if named else (0 if name else -1),
        1 if ANNOUNCE.search(before) else -1,
        0 if HARMLESS.search(before) else -1,
        1 if mixed else (0 if kind == "secret" else -1),
    )
    shape = (1, kind == "secret", kind == "number", kind == "handle", named, end - start >= 16,
             digits >= 4, letters >= 3, value.isupper(), bool(name), " " in value or "-" in value,
             start > 0 and text[start - 1] in "\"'")
    return Candidate(kind, start, end, votes, tuple(map(int, shape)))


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[Candidate]:
    """Candidates of the further kinds that overlap no earlier span."""
    marks = [(a, b) for _, a, b in taken]
    found = []
    # What a pattern cannot do without; most texts have none of it.
    digit = _DIGIT.search(text) is not None
    needed = ("=" in text or ":" in text, digit, digit, digit, "@" in text)
    for k, (kind, pattern) in enumerate(_CANDIDATES):
        if not needed[k]:
            continue
        for m in pattern.finditer(text):
            start, end = m.span("value")
            if any(a < end and start < b for a, b in marks):
                continue
            marks.append((start, end))
            name = m["name"] if "name" in pattern.groupindex else None
            found.append(_judged(text, kind, start, end, name, k in (0, 1, 2)))
    return found


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Probability that each vote pattern is personal data, by expectation-maximisation.

    A labeler has a rate of each of its votes in either class; votes are independent
    within a class. The start is the majority of the votes.
    """
    yes, no = (votes == 1).sum(1), (votes == 0).sum(1)
    p = (yes + 0.5) / (yes + no + 1.0)
    for _ in range(rounds):
        share = np.clip((counts * p).sum() / max(counts.sum(), 1), 0.01, 0.99)
        score = np.full(len(p), np.log(share / (1 - share)))
        for j in range(votes.shape[1]):
            for vote in (-1, 0, 1):
                same = votes[:, j] == vote
                # Half a count of each vote keeps rates off 0; yes votes lean to yes.
                in_yes = (counts * p)[same].sum() + (1.0 if vote == 1 else 0.5)
                in_no = (counts * (1 - p))[same].sum() + (1.0 if vote == 0 else 0.5)
                rate_yes = in_yes / ((counts * p).sum() + 2.0)
                rate_no = in_no / ((counts * (1 - p)).sum() + 2.0)
                score[same] += np.log(rate_yes / rate_no)
        new = 1 / (1 + np.exp(-score))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p


def trained(features: np.ndarray, target: np.ndarray, counts: np.ndarray,
            rounds: int = 50) -> np.ndarray:
    """Weights of a logistic classifier of soft targets (Newton steps, ridge 1)."""
    weights = np.zeros(features.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-features @ weights))
        gradient = features.T @ (counts * (target - p)) - weights
        curvature = (features * (counts * p * (1 - p))[:, None]).T @ features
        step = np.linalg.solve(curvature + np.eye(len(weights)), gradient)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def _texts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for whole in batches:
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            yield batch, [t or "" for t in batch.column(at).to_pylist()]


def fit(docs: DataFrame, text: str = "text") -> np.ndarray | None:
    """Classifier weights from the candidates of all documents; None without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, int] = {}
        for _, texts in _texts(batches, 0):
            for t in texts:
                for c in candidates(t, base_spans(t)):
                    sums[c.votes, c.features] = sums.get((c.votes, c.features), 0) + 1
        yield pa.RecordBatch.from_arrays([
            pa.array([v for v, _ in sums], pa.list_(pa.int32())),
            pa.array([f for _, f in sums], pa.list_(pa.int32())),
            pa.array(list(sums.values()), pa.int64())], names=["votes", "features", "n"])

    rows = docs.select(text).mapInArrow(
        run, "votes array<int>, features array<int>, n long"
    ).groupBy("votes", "features").agg(F.sum("n").alias("n")).orderBy("votes", "features").collect()
    if not rows:
        return None
    votes = np.array([r["votes"] for r in rows])
    features = np.array([r["features"] for r in rows], dtype=float)
    counts = np.array([r["n"] for r in rows], dtype=float)
    return trained(features, estimate(votes, counts), counts)


def find(docs: DataFrame, weights: np.ndarray | None, id_: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Per row: id, the number of spans of each base kind, base_sha256 and all spans."""

    def listed(spans: list[tuple[str, int, int]]) -> str:
        return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    names = ["id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches, 1):
            counts, digests, spans = [], [], []
            for t in texts:
                base = base_spans(t)
                more = [] if weights is None else [
                    (c.kind, c.start, c.end) for c in candidates(t, base)
                    if 1 / (1 + np.exp(-np.dot(c.features, weights))) >= ACCEPT]
                more.sort(key=lambda s: (MORE_KINDS.index(s[0]), s[1]))
                kinds = [k for k, _, _ in base]
                counts.append([kinds.count(k) for k in BASE_KINDS])
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(base + more))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 *[pa.array([c[k] for c in counts], pa.int64()) for k in range(len(BASE_KINDS))],
                 pa.array(digests), pa.array(spans, pa.string())], names=names)

    kind = docs.schema[id_].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{n} long" for n in names[1:5]) + (
        ", base_sha256 string, spans string")
    return docs.select(id_, text).mapInArrow(run, schema).withColumnRenamed("id", id_)


def redacted(text: str, spans: str) -> str:
    """``text`` with every span of ``find`` replaced by its kind in brackets."""
    parts = [s.split(":") for s in spans.split(",") if s]
    for kind, start, end in sorted(parts, key=lambda s: -int(s[1])):
        text = f"{text[:int(start)]}[{kind}]{text[int(end):]}"
    return text
