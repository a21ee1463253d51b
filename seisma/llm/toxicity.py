"""Toxicity severity by cumulative-link ordinal regression on sparse words.

The model is the proportional-odds one: one weight vector ``w`` shared by all
thresholds and ordered cut points ``b_1 < b_2 < ... < b_{K-1}`` with
``P(grade >= k | x) = sigmoid(w.x - b_k)``; the expected severity is the sum of
those probabilities.  Features are the words of the text (A-Z lower-cased, runs
of letters) and the words' beginnings, which stand for a stem with its endings;
each has the value ``1 + ln(count)``.  Only features whose presence goes with
the label beyond chance (likelihood ratio) enter the model.

The fit runs on the driver over a bounded sample of labelled rows
(``max_rows``, chosen by a hash of the id, so it is the same on every run);
scoring is one pass over all documents without a shuffle.

Defined results: a null or empty text has no words and scores the intercept; a
word unseen in the sample adds nothing; rows with a null label or id and
labels without a document take no part in the fit; a text labelled more than
once counts once, toxic if any label says so; with no toxic labelled rows at
all every document scores severity 0; repeated rows score alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seisma.llm.tables import filter_batches, utf8

#: Everything but letters (ASCII letters and all of UTF-8 beyond ASCII) separates words; A-Z fold.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

MAX_ROWS = 12_000
MIN_DOCS = 3
GRADES = 4
REJECT = 0.5
#: Lengths of word beginnings in UTF-8 bytes.
STEMS = range(4, 9)
#: Likelihood ratio that a feature must reach: one in a million by chance alone.
SIGNIFICANT = 24.0
_KEEP_WORDS = 200_000


def _words(raw: bytes | None) -> list[bytes]:
    return raw.translate(_LETTERS).split() if raw else []


def _features(word: bytes) -> list[bytes]:
    """The word itself and its beginnings, which are marked by a star."""
    return [word, *(word[:n] + b"*" for n in STEMS if n <= len(word))]


class _Known(dict):
    """Model features of a word, remembered up to a bound."""

    def __init__(self, weights: dict[bytes, float]):
        self.weights = weights

    def __missing__(self, word: bytes) -> tuple[bytes, ...]:
        if len(self) >= _KEEP_WORDS:
            self.clear()
        got = self[word] = tuple(f for f in _features(word) if f in self.weights)
        return got


@dataclass
class OrdinalModel:
    """Features with their weights, and the ordered cut points."""

    weights: dict[bytes, float] = field(default_factory=dict)
    cuts: list[float] = field(default_factory=list)

    def __post_init__(self):
        self.known = _Known(self.weights)

    def __reduce__(self):
        return OrdinalModel, (self.weights, self.cuts)

    def counts(self, raw: bytes | None) -> Counter:
        return Counter(f for fs in map(self.known.__getitem__, _words(raw)) if fs for f in fs)

    def probabilities(self, raw: bytes | None) -> list[float]:
        """P(grade >= k) for k = 1 .. K-1, never increasing in k."""
        z = sum(self.weights[f] * (1.0 + log(n)) for f, n in self.counts(raw).items())
        return [1.0 / (1.0 + exp(min(50.0, max(-50.0, b - z)))) for b in self.cuts]


def select_features(texts: list[bytes | None], toxic: np.ndarray) -> list[bytes]:
    """Features in at least ``MIN_DOCS`` toxic texts whose presence depends on the label, in byte order."""
    bad, good = Counter(), Counter()
    for raw, y in zip(texts, toxic):
        if y:
            bad.update({f for w in set(_words(raw)) for f in _features(w)})
    of = _Known({f: 1.0 for f, n in bad.items() if n >= MIN_DOCS})
    for raw, y in zip(texts, toxic):
        if not y:
            good.update({f for w in set(_words(raw)) for f in of[w]})
    names = sorted(of.weights)
    a = np.array([bad[f] for f in names], dtype=float)
    b = np.array([good[f] for f in names], dtype=float)
    n1, n0 = float(toxic.sum()), float((~toxic).sum())
    if not names or not n1 or not n0:
        return []

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    here, n = a + b, n1 + n0
    ratio = 2 * (part(a, here * n1 / n) + part(b, here * n0 / n) + part(n1 - a, (n - here) * n1 / n) + part(n0 - b, (n - here) * n0 / n))
    return [f for f, r in zip(names, ratio) if r >= SIGNIFICANT]


def severity_grades(texts: list[bytes | None], toxic: np.ndarray, marks: list[bytes] | None = None, grades: int = GRADES) -> np.ndarray:
    """Ordered grades 0 .. grades-1 out of yes/no labels.

    Grade 0 are rows labelled not toxic.  Marks are the selected features that
    occur in toxic rows mostly; a toxic row gets grade 1 and one more each time
    its number of words with a mark passes 2, 4, 8 and so on.
    """
    t = np.asarray(toxic, dtype=bool)
    marks = select_features(texts, t) if marks is None else marks
    of = _Known(dict.fromkeys(marks, 1.0))
    bad, all_ = Counter(), Counter()
    for raw, y in zip(texts, t):
        here = {f for w in set(_words(raw)) for f in of[w]}
        all_.update(here)
        if y:
            bad.update(here)
    strong = _Known({f: 1.0 for f, n in all_.items() if 2 * bad[f] > n})
    hits = np.array([sum(bool(strong[w]) for w in _words(raw)) for raw in texts], dtype=float)
    return np.where(t, 1 + sum((hits > 2.0**k).astype(int) for k in range(1, grades - 1)), 0).astype(int)


def fit(texts: list[bytes | None], grades: np.ndarray, names: list[bytes] | None = None, n_grades: int = GRADES, l2: float = 0.3, steps: int = 800) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty by scaled gradient steps on the K-1 threshold losses."""
    grades = np.asarray(grades, dtype=int)
    n = len(grades)
    if not n or not (grades > 0).any():
        return OrdinalModel()
    names = select_features(texts, grades > 0) if names is None else names
    shell = OrdinalModel(dict.fromkeys(names, 0.0))
    column = {f: j for j, f in enumerate(names)}
    row, col, val = [], [], []
    for r, raw in enumerate(texts):
        for f, k in shell.counts(raw).items():
            row.append(r)
            col.append(column[f])
            val.append(1.0 + log(k))
    row, col, val, d = np.array(row, dtype=np.int64), np.array(col, dtype=np.int64), np.array(val), len(names)
    above = (grades[:, None] >= np.arange(1, n_grades)[None, :]).astype(float)
    share = above.mean(axis=0).clip(0.5 / n, 1 - 0.5 / n)
    cuts = np.maximum.accumulate(np.log((1 - share) / share))
    w, m_w, m_b, v_w, v_b = np.zeros(d), np.zeros(d), np.zeros(n_grades - 1), np.zeros(d), np.zeros(n_grades - 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=val * w[col], minlength=n)
        miss = 1.0 / (1.0 + np.exp(np.clip(cuts[None, :] - z[:, None], -50, 50))) - above
        g_w = np.bincount(col, weights=val * miss.sum(axis=1)[row], minlength=d) + l2 * w
        g_b = -miss.sum(axis=0)
        m_w, m_b = 0.9 * m_w + 0.1 * g_w, 0.9 * m_b + 0.1 * g_b
        v_w, v_b = 0.99 * v_w + 0.01 * g_w**2, 0.99 * v_b + 0.01 * g_b**2
        rate = 0.05 * (1 - 0.9 * t / steps)
        w -= rate * (m_w / (1 - 0.9**t)) / (np.sqrt(v_w / (1 - 0.99**t)) + 1e-8)
        cuts = np.maximum.accumulate(cuts - rate * (m_b / (1 - 0.9**t)) / (np.sqrt(v_b / (1 - 0.99**t)) + 1e-8))  # stays ordered
    return OrdinalModel({f: float(w[j]) for f, j in column.items() if abs(w[j]) > 1e-3}, [float(b) for b in cuts])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> OrdinalModel:
    """Fit on at most ``max_rows`` labelled documents (the smallest hashes of the id)."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )
    rows = (
        docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
        .join(F.broadcast(known), "_id")  # at most max_rows rows of two numbers
        .groupBy("_text").agg(F.max("_y").alias("_y"))  # copies count once
        .orderBy(F.xxhash64("_text"), "_text").toArrow()
    )
    texts, y = utf8(rows.column("_text").combine_chunks()), np.array(rows.column("_y").to_pylist(), dtype=bool)
    names = select_features(texts, y)
    return fit(texts, severity_grades(texts, y, names), names)


def score(docs: DataFrame, model: OrdinalModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, P(toxic), severity (expected grade), grade (most probable thresholds passed), rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            p = [m.probabilities(x) for x in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([
                b.column(0),
                pa.array([x[0] if x else 0.0 for x in p], pa.float64()),
                pa.array([sum(x) for x in p], pa.float64()),
                pa.array([sum(v >= REJECT for v in x) for x in p], pa.int32()),
                pa.array([bool(x) and x[0] >= REJECT for x in p], pa.bool_()),
            ], names=["doc_id", "p_toxic", "severity", "grade", "rejected"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(
        run, f"doc_id {kind}, p_toxic double, severity double, grade int, rejected boolean")


def keep_clean(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """The rows whose P(toxic) stays below one half, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def keep(b: pa.RecordBatch) -> list[bool]:
        m = shared.value
        return [not p or p[0] < REJECT for p in map(m.probabilities, utf8(b.column(at)))]

    return filter_batches(docs, keep)
