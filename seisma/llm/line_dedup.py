"""Fuzzy line de-duplication by MinHash over character shingles.

Lines (between line ends) are folded: A-Z lower-cased, runs of white space one
space, ends trimmed.  Every line that is not blank takes part; one shorter than
a shingle is similar to its equals only.  Blank lines always stay.

1. One pass over the texts gives each line a 64-bit id of its folded text and
   ``BANDS`` band hashes over ``ROWS`` minima each, of ``SHINGLE``-character
   shingles.  Equal lines have equal ids, so copies are one line from here on.
2. Lines that share a band come together in groups (``linkage.members``).
3. Their shingle sets are read from the texts again and every pair of a group
   is checked exactly, in bounded cells: Jaccard similarity of 0.8 or more links.
4. Components of links keep their first line (smallest doc_id, then line number).

At similarity 0.8 a pair shares no band with probability 0.5 %, at 0.9 with
probability 2e-5.

Defined results: a null text stays null; an empty text and texts of blank lines
alone stay as they are; a document may lose all its lines and is then empty
text, its row stays; repeated rows of one doc_id are one document and keep the
same lines; rows with a null doc_id keep all lines, and come first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from seisma.llm import linkage
from seisma.llm.shingles import char_shingles, mix, signed
from seisma.llm.tables import slices, small, stored, tidy, written

SHINGLE = 8
BANDS = 10
ROWS = 4
PERCENT = 80

_R = np.random.default_rng(8)
_XOR = _R.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_ODD = _R.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND = _R.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_AT_ONCE = 50_000  # characters hashed at once


def fold(line: str) -> str | None:
    """The folded line, or None where it is blank."""
    words = line.split()
    if not words:
        return None
    return " ".join(words).encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes fold A-Z alone


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def line_id(folded: str) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(folded.encode("utf-8", "surrogatepass"))).astype(np.int64))


def band_hashes(lines: list[str]) -> np.ndarray:
    """One row of band hashes for each folded line (lines shorter than a shingle are padded with spaces)."""
    if not lines:
        return np.zeros((0, BANDS), dtype=np.int64)
    lines = [x.ljust(SHINGLE) for x in lines]
    lengths = np.array([len(x) for x in lines])
    windows = char_shingles(_codes("".join(lines)), SHINGLE)
    counts = lengths - SHINGLE + 1  # windows that run into the next line are left out
    start = np.cumsum(counts) - counts
    at = np.arange(int(counts.sum())) + np.repeat(np.arange(len(lines)) * (SHINGLE - 1), counts)
    h = (windows[at] >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((len(lines), BANDS * ROWS), dtype=np.uint64)
    now = np.empty_like(h)
    for k in range(BANDS * ROWS):
        np.bitwise_xor(h, _XOR[k], out=now)
        np.multiply(now, _ODD[k], out=now)
        minima[:, k] = np.minimum.reduceat(now, start)
    bands = (minima.reshape(-1, BANDS, ROWS) * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    return signed(mix(bands))


def shingle_set(folded: str) -> np.ndarray:
    return np.unique(char_shingles(_codes(folded.ljust(SHINGLE)), SHINGLE))


def _signatures(docs: DataFrame) -> DataFrame:
    """doc_id, line (its number), id and bands for every line that takes part."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 1)):
            owner, number, ids, bands, waiting, size = [], [], [], [], [], 0
            for i, text in enumerate(b.column(1).to_pylist()):
                lines = [(k, f) for k, x in enumerate((text or "").split("\n")) if (f := fold(x)) is not None]
                owner += [i] * len(lines)
                number += [k for k, _ in lines]
                ids += [line_id(f) for _, f in lines]
                waiting += [f for _, f in lines]
                size += len(text or "")
                if size >= _AT_ONCE:
                    bands.append(band_hashes(waiting))
                    waiting, size = [], 0
            bands.append(band_hashes(waiting))
            values = np.concatenate(bands)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int32())), pa.array(number, pa.int32()), pa.array(ids, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * BANDS, pa.int32()), pa.array(values.ravel()))],
                names=["doc_id", "line", "id", "bands"])

    return docs.mapInArrow(tidy(run), f"doc_id {kind}, line int, id bigint, bands array<bigint>")


def _sets(docs: DataFrame) -> DataFrame:
    """id and elements (the folded text) of the wanted lines (column ``wanted``: their numbers) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 0)):
            ids, sets = [], []
            for text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                lines = (text or "").split("\n")
                for folded in (fold(lines[k]) for k in wanted if k < len(lines)):
                    if folded is not None:
                        ids.append(line_id(folded))
                        sets.append(folded)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.string())], names=["id", "elements"])

    return docs.select("text", "wanted").mapInArrow(tidy(run), "id bigint, elements string").dropDuplicates(["id"])


def dropped_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the sorted numbers of the lines that go, for documents that lose any."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    lines = written(_signatures(texts), "lines")
    groups = stored(linkage.members(lines.select("id", F.explode("bands").alias("key"))))

    wanted = groups.select("id").distinct()
    place = lines.where(F.col("doc_id").isNotNull()).join(small(wanted), "id", "left_semi").groupBy("id").agg(F.min(F.struct("doc_id", "line")).alias("at"))
    by_doc = stored(place.groupBy(F.col("at.doc_id").alias("doc_id")).agg(F.collect_set("at.line").alias("wanted")))
    sets = stored(_sets(texts.join(small(by_doc), "doc_id")))

    found = linkage.components(linkage.links(groups, sets, PERCENT, read=shingle_set))
    lone = lines.select("doc_id", "line", "id")
    named = lone.join(small(stored(found)), "id", "left").select("doc_id", "line", F.coalesce("component", "id").alias("component"))
    firsts = named.groupBy("component").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.max(F.struct("doc_id", "line")).alias("_last"))
    firsts = stored(firsts.where(F.col("first") != F.col("_last")).select("component", "first"))
    gone = named.join(small(firsts), "component").where((F.struct("doc_id", "line") != F.col("first")) & F.col("doc_id").isNotNull())
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("dropped"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", report: str = "dropped_lines") -> DataFrame:
    """The documents with the dropped lines taken out of ``text``, and their numbers in ``report`` (null for none).

    An input column named like ``report`` is left out.
    """
    drop = "__gone"
    while drop in docs.columns:
        drop += "_"
    gone = stored(dropped_lines(docs, doc_id, text)).select(F.col("doc_id").alias(doc_id), F.col("dropped").alias(drop))
    body = F.col(text).cast("string")
    left = F.filter(F.split(body, "\n", -1), lambda x, k: ~F.array_contains(drop, k))
    new = F.when(F.col(drop).isNull(), body).otherwise(F.array_join(left, "\n")).alias(text)
    columns = [new if c == text else F.col(c) for c in docs.columns if c != report]
    return docs.join(small(gone), doc_id, "left").select(*columns, F.col(drop).alias(report))
