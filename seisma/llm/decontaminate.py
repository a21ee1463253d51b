"""Benchmark decontamination with one Aho-Corasick automaton.

Items and documents are normalised alike: A-Z lower-cased, words are the runs
of characters other than ASCII non-alphanumerics.  Each window of
``window`` consecutive item words (an item of fewer words, but not none, is one
window) becomes a pattern over word numbers; one automaton holds all patterns,
and a document's word sequence runs through it once.  Every word inside an
occurrence is hit, and hit stretches are mapped back to code points of the
original text.

The automaton is built from at most ``block_bytes`` of benchmark text; a larger
benchmark is read in blocks that each scan the documents once, with the hits of
earlier blocks carried along.

Defined results: a null or empty text has no words and no hits; an item with a
null id or without words takes no part; repeated item ids are one item;
repeated documents each get their row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import ceil

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seisma.llm.tables import filter_batches, stored, utf8

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WINDOW = 10
#: An automaton takes about 150 times its items' bytes in a worker and some 3 seconds a MB to build.
BLOCK_BYTES = 2 << 20


class Matcher:
    """The automaton over word numbers; 0 is any word that no item has."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, raw in items:
            words = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in raw.translate(_WORDS).split())
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(words[i : i + window], set()).add(name)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, names in owners.items():
            self.automaton.add_word(pattern, (len(pattern), names))
        if owners:
            self.automaton.make_automaton()
        self.any = bool(owners)

    def scan(self, raw: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit stretches as (first word, end word), and the items that occur."""
        words = raw.translate(_WORDS).split() if raw else []
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        if words and self.any:
            number = self.numbers.get
            for end, (length, owners) in self.automaton.iter(tuple([number(w, 0) for w in words])):
                names |= owners
                start = end + 1 - length
                while spans and spans[-1][1] >= start:  # ends never fall, so only the last stretches can touch
                    start = min(start, spans.pop()[0])
                spans.append((start, end + 1))
        return len(words), spans, names


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _offsets(raw: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Word stretches as code point stretches of the original text."""
    at = [m.span() for m in _WORD.finditer(raw.decode("utf-8", "replace"))]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in spans]


def blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Item texts for the driver, block after block of about ``block_bytes``."""
    items = benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("string").alias("text")).distinct()
    n = max(1, ceil((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / block_bytes))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = part.toArrow()
        yield list(zip(rows.column("item_id").to_pylist(), utf8(rows.column("text").combine_chunks())))


_STATE = "n_words bigint, words array<struct<start:int,end:int>>, items array<string>"


def scan(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (sorted strings), spans (code points, end exclusive)."""
    spark, kind = docs.sparkSession, docs.schema[doc_id].dataType.simpleString()
    state = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    for k, items in enumerate(blocks(benchmark, item_id, item_text, block_bytes)):
        shared = spark.sparkContext.broadcast((items, window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first=k == 0) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(*shared.value)
            for b in batches:
                n, spans, names = [], [], []
                for i, raw in enumerate(utf8(b.column(1))):
                    words, hit, found = matcher.scan(raw)
                    if not first:
                        hit = _merged([*hit, *((x["start"], x["end"]) for x in b.column(3)[i].as_py())])
                        found = found | set(b.column(4)[i].as_py())
                    n.append(words)
                    spans.append([{"start": x, "end": y} for x, y in hit])
                    names.append(sorted(found))
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array(n, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(names, pa.list_(pa.string())),
                ], names=["doc_id", "text", "n_words", "words", "items"])

        if k:
            state = stored(state)
        state = state.mapInArrow(run, f"doc_id {kind}, text string, {_STATE}")

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            words = b.column(3).to_pylist()
            raws = utf8(b.column(1))
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2),
                pa.array([sum(x["end"] - x["start"] for x in w) for w in words], pa.int64()),
                b.column(4),
                pa.array([_offsets(r, [(x["start"], x["end"]) for x in w]) if w else [] for r, w in zip(raws, words)], kind),
            ], names=["doc_id", "n_words", "n_hit", "item_ids", "spans"])

    return state.mapInArrow(located, f"doc_id {kind}, n_words bigint, n_hit bigint, item_ids array<string>, spans array<struct<start:int,end:int>>")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows in which no window occurs, all columns unchanged."""
    at, out = docs.columns.index(text), docs
    for items in blocks(benchmark, item_id, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast((items, window))
        made: list[Matcher] = []

        def keep(b: pa.RecordBatch, shared=shared, made=made) -> list[bool]:
            if not made:
                made.append(Matcher(*shared.value))
            return [not made[0].scan(raw)[1] for raw in utf8(b.column(at))]

        out = filter_batches(out, keep)
    return out


def digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()
