"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every word has a slot (a hash of the word) and every slot a sparse random index
vector of a few +1 and -1.  A slot's context vector is the sum of the index
vectors of the words that stand within ``WINDOW`` places of its words, over the
whole corpus.  These sums are integers, so they do not depend on order or
partitioning: each task adds up its own documents into a table of ``SLOTS`` x
``DIM`` numbers, and the tables are added slice by slice in two shuffles, the
first of them salted.  Frequent words rule their slots; rare words share theirs.

A document is pooled into the mean and the spread of its words' vectors, the
mean over its distinct words, the mean product of neighbouring words' vectors,
its length and its share of distinct words.  A
two-layer network (tanh, then a logistic output) is fitted in numpy on a bounded
sample of labelled rows; a part of the sample is kept aside to choose the
temperature that calibrates its probabilities.

Defined results: a null or empty text is pooled into zeros and scored as such;
labels that are null or without a document take no part; a document labelled more than once counts once with the
higher label; without labelled rows of both classes every score is the share of
the higher class (one half without any); repeated rows score alike; other
columns are left aside.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from seisma.llm.tables import written

SLOTS = 1 << 14
DIM = 64
#: Non-zero places of an index vector, and words on each side that count as context.
PLACES = 4
WINDOW = 2
#: The fit's bounds: labelled rows, hidden units, rounds; the part kept aside for the temperature.
MAX_ROWS = 12_000
HIDDEN = 32
ROUNDS = 300
ASIDE = 0.2
THRESHOLD = 0.3
_SLICES = 16
_SALTS = 64
_WORDS = 200_000
_TOKENS = 1 << 20  # words that are counted at once
_NEAR = 1 << 15

_find = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+").findall


class _Slots(dict):
    """Slot of a word, remembered up to a bound; long words are not kept."""

    def __missing__(self, word: str) -> int:
        slot = zlib.crc32(word.encode()) & (SLOTS - 1)
        if len(word) <= 40:
            if len(self) >= _WORDS:
                self.clear()
            self[word] = slot
        return slot


_slots = _Slots()


def slots_of(text: str | None) -> np.ndarray:
    """Slots of a text's words, runs of digits and runs of marks, letters lower-cased."""
    words = _find(text.lower()) if text else []
    return np.fromiter(map(_slots.__getitem__, words), np.int64, len(words))


def index_places() -> np.ndarray:
    """For every slot, the places of its index vector: below DIM they stand for +1, from there on for -1."""
    rng = np.random.default_rng(20_240_131)
    place = np.argsort(rng.random((SLOTS, DIM)), axis=1)[:, :PLACES]
    return (place + DIM * rng.integers(0, 2, (SLOTS, PLACES))).astype(np.int64)


def add_contexts(table: np.ndarray, slots: np.ndarray, doc: np.ndarray, places: np.ndarray) -> None:
    """Add to ``table`` (SLOTS x 2 DIM, flat) the contexts of all words; neighbours are of the same document."""
    for step in range(1, WINDOW + 1):
        near = doc[step:] == doc[:-step]
        left, right = slots[:-step][near], slots[step:][near]
        for here, there in ((left, right), (right, left)):
            for k in range(PLACES):
                table += np.bincount(here * (2 * DIM) + places[there, k], minlength=len(table))


def contexts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors of all slots over all documents (SLOTS x DIM integers)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, table, seen = index_places(), np.zeros(SLOTS * 2 * DIM, np.int64), False
        held, doc, size, n = [], [], 0, 0
        for b in batches:
            for t in b.column(0).to_pylist():
                s = slots_of(t)
                if len(s):
                    held.append(s)
                    size, n, seen = size + len(s), n + 1, True
                if size >= _TOKENS:
                    add_contexts(table, np.concatenate(held), np.repeat(np.arange(len(held)), [len(x) for x in held]), places)
                    held, size = [], 0
        if held:
            add_contexts(table, np.concatenate(held), np.repeat(np.arange(len(held)), [len(x) for x in held]), places)
        if seen:
            net = table.reshape(SLOTS, 2, DIM)
            yield _rows(TaskContext.get().partitionId(), net[:, 0] - net[:, 1])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for part, slice_, raw in zip(*(c.to_pylist() for c in b.columns)):
                got = np.frombuffer(raw, "<i8")
                key = (part % _SALTS, slice_)
                if sums and key not in sums:  # rows come sorted by key
                    yield _sums(sums)
                    sums = {}
                sums[key] = sums[key] + got if key in sums else got
        if sums:
            yield _sums(sums)

    shape = "part int, slice int, sums binary"
    parts = written(docs.select(F.col(text).cast("string")).mapInArrow(count, shape), "quality-contexts")
    salt = F.col("part") % _SALTS
    some = parts.repartition(salt, "slice").sortWithinPartitions(salt, "slice").mapInArrow(add, shape)
    all_ = some.withColumn("part", F.lit(0)).repartition("slice").sortWithinPartitions("slice").mapInArrow(add, shape)
    out = np.zeros((_SLICES, SLOTS // _SLICES * DIM), np.int64)
    for r in all_.collect():  # _SLICES rows: the model's table
        out[r.slice] = np.frombuffer(r.sums, "<i8")
    return out.reshape(SLOTS, DIM)


def _rows(part: int, table: np.ndarray) -> pa.RecordBatch:
    pieces = np.split(table.astype("<i8"), _SLICES)
    return pa.RecordBatch.from_arrays([pa.array([part] * _SLICES, pa.int32()), pa.array(range(_SLICES), pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())],
                                      names=["part", "slice", "sums"])


def _sums(sums: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                      names=["part", "slice", "sums"])


def word_vectors(table: np.ndarray) -> np.ndarray:
    """Context vectors made comparable: square roots, the common direction taken out, unit length."""
    v = np.sign(table) * np.sqrt(np.abs(table))
    length = np.linalg.norm(v, axis=1, keepdims=True)
    v = np.divide(v, length, out=np.zeros_like(v), where=length > 0)
    used = length[:, 0] > 0
    if used.any():
        v[used] -= v[used].mean(axis=0)
    return v


N_FEATURES = 4 * DIM + 2


def pooled(slots: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A document's features."""
    out = np.zeros(N_FEATURES)
    if len(slots):
        distinct, times = np.unique(slots, return_counts=True)
        v, share = vectors[distinct], times / len(slots)
        mean = share @ v
        out[:DIM] = mean
        out[DIM : 2 * DIM] = np.sqrt(np.maximum(share @ (v * v) - mean * mean, 0))
        out[2 * DIM : 3 * DIM] = v.mean(axis=0)
        if len(slots) > 1:
            for at in range(0, len(slots) - 1, _NEAR):  # long texts in steps
                near = vectors[slots[at : at + _NEAR + 1]]
                out[3 * DIM : 4 * DIM] += np.einsum("ij,ij->j", near[1:], near[:-1])
            out[3 * DIM : 4 * DIM] /= len(slots) - 1
        out[4 * DIM :] = np.log1p(len(slots)), len(distinct) / len(slots)
    return out


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the output before the logistic function."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def constant(share: float) -> Network:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Network(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros((N_FEATURES, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def gradients(net: Network, x: np.ndarray, y: np.ndarray, l2: float) -> tuple[list[np.ndarray], float]:
    """Gradients (w1, b1, w2, b2) of the penalised mean log loss at standardised ``x``, and the loss."""
    h = np.tanh(x @ net.w1 + net.b1)
    z = h @ net.w2 + net.b2
    miss = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
    back = np.outer(miss, net.w2) * (1 - h * h)
    loss = log_loss(z, y) + l2 / 2 * (float((net.w1**2).sum()) + float((net.w2**2).sum()))
    return [x.T @ back + l2 * net.w1, back.sum(axis=0), h.T @ miss + l2 * net.w2, miss.sum()], loss


def fit(x: np.ndarray, y: np.ndarray, aside: np.ndarray, l2: float = 1e-3, rate: float = 0.02, rounds: int = ROUNDS) -> Network:
    """Adam on all rows that are not ``aside``; those choose the temperature, one half at least (all rows, where a class is missing there)."""
    y = np.asarray(y, dtype=float)
    if not len(y) or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    own = ~aside
    if y[own].min(initial=1) == y[own].max(initial=0):
        own = np.ones(len(y), dtype=bool)
    rng = np.random.default_rng(7)
    mean, scale = x[own].mean(axis=0), x[own].std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    net = Network(mean, scale, rng.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), float(np.log(y[own].mean() / (1 - y[own].mean()))))
    xs, ys = (x[own] - mean) / scale, y[own]
    m = [0.0] * 4
    v = [0.0] * 4
    for t in range(1, rounds + 1):
        for k, g in enumerate(gradients(net, xs, ys, l2)[0]):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            step = rate * (1 - 0.9 * t / rounds) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
            name = ("w1", "b1", "w2", "b2")[k]
            setattr(net, name, getattr(net, name) - step)
    held = aside if aside.any() and y[aside].min() != y[aside].max() else np.ones(len(y), dtype=bool)
    z = net.logits(x[held])
    net.temperature = float(min(np.geomspace(0.5, 8, 200), key=lambda c: log_loss(z / c, y[held])))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: the checksum of the id's text is a multiple of 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _features(rows: DataFrame, vectors: np.ndarray, result: Callable[[np.ndarray], list[pa.Array]], fields: str, text: int) -> DataFrame:
    """All columns of ``rows`` but the text, then the fields that ``result`` makes of the features."""
    shared = rows.sparkSession.sparkContext.broadcast(vectors.astype(np.float32))  # SLOTS x DIM numbers
    names = [c for i, c in enumerate(rows.columns) if i != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                x = np.array([pooled(slots_of(t), v) for t in b.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != text), *result(x)], names=[*names, *(f.split()[0] for f in fields.split(", "))])

    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(run, f"{kept}, {fields}")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Word vectors of all documents; the network of at most ``max_rows`` labelled ones (the smallest hashes of the id)."""
    vectors = word_vectors(contexts(docs, text))
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_y"))
    )
    # narrow rows choose the sample; the texts meet only its max_rows ids
    sample = docs.select(F.col(doc_id).alias("_id")).join(known, "_id").groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    rows = texts.join(F.broadcast(sample), "_id").groupBy("_id").agg(F.max("_y").alias("_y"), F.min("_text").alias("_text"))
    found = _features(rows.select("_id", "_y", "_text"), vectors, lambda x: [pa.array(list(x.astype(np.float64)), pa.list_(pa.float64()))], "x array<double>", 2)
    table = found.toArrow().sort_by("_id")  # max_rows rows of N_FEATURES numbers
    x = np.array(table.column("x").to_pylist(), dtype=float).reshape(-1, N_FEATURES)
    y = np.array(table.column("_y").to_pylist(), dtype=float)
    aside = np.array([zlib.crc32(b"aside" + str(i).encode()) % 1000 < 1000 * ASIDE for i in table.column("_id").to_pylist()], dtype=bool)
    return Model(vectors, fit(x, y, aside))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    net = model.network

    def result(x: np.ndarray) -> list[pa.Array]:
        p = net.probabilities(x)
        return [pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32), pa.int32())]

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).cast("string").alias("text"))
    return _features(rows, model.vectors, result, "score double, predicted int", 2)
