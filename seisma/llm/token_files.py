"""Token-id files in Simple-8b word-aligned coding.

Words are 64 bits: the low four bits name a selector, the other sixty hold as
many ids as the selector says, each in the same number of bits.  Ids of more
than sixty bits escape: one word (selector 15) has the low sixty bits and the
next (selector 14) the rest.  A document's ids are cut into blocks of
``BLOCK`` ids that begin on a word, and the record carries each block's word
offset, so that blocks are packed and unpacked all at once with array
operations.

A record is ``u32 n_ids, u32 n_blocks, u32 offset[n_blocks], padding to eight
bytes, u64 word[...]``, little-endian.  ``write`` brings the documents into ascending id order by one
range shuffle, encodes them and writes the records with Spark's writer; ``read``
decodes the files again.

Defined results: a null text is the empty text (the end id alone); null ids come
first; rows with equal ids are ordered by their texts' hashes; an empty table writes
an empty folder.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from seisma.llm.chunks import Memory, byte_symbols, cut, cuts_at_space, cuts_by_class, library, pieces, plain_bytes
from seisma.llm.tables import slices

BLOCK = 128
#: Fixed values of the coding: ids a word, bits an id, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60, 60])
_LAST = 13  # selectors up to here are chosen by width
_LOW = np.uint64((1 << 60) - 1)


def _layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block starts (in the joint id array), block sizes, and the document of each block."""
    n_blocks = -(-lengths // BLOCK)
    doc = np.repeat(np.arange(len(lengths)), n_blocks)
    inside = np.arange(len(doc)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    begin = np.repeat(np.cumsum(lengths) - lengths, n_blocks) + inside * BLOCK
    return begin, np.minimum(BLOCK, np.repeat(lengths, n_blocks) - inside * BLOCK), doc


def _selectors(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each id the first selector with which a word that begins there holds all ids it can, up to its block's end."""
    need = np.zeros(len(ids), dtype=np.uint8)  # the first selector wide enough for the id itself
    top = int(ids.max()) if len(ids) else 0
    for bits in BITS[: _LAST + 1].tolist():
        if top >> bits == 0:
            break
        need += ids >= ids.dtype.type(1 << bits)
    inside = np.arange(BLOCK) < sizes[:, None]
    wide = {1: np.zeros((len(sizes), BLOCK + int(COUNTS.max())), dtype=np.uint8)}  # behind a block all ids fit
    wide[1][:, :BLOCK][inside] = need
    for n in sorted(set(COUNTS[: _LAST + 1].tolist()) - {1}):  # the largest need among n ids, from two windows of half of them
        half = min(k for k in wide if 2 * k >= n)
        wide[n] = wide[half].copy()
        np.maximum(wide[n][:, : half - n], wide[half][:, n - half :], out=wide[n][:, : half - n])
    selector = np.full((len(sizes), BLOCK), 15, dtype=np.uint8)
    for s in range(_LAST, -1, -1):
        np.copyto(selector, np.uint8(s), where=wide[int(COUNTS[s])][:, :BLOCK] <= s)
    return selector[inside]


def pack(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """One record for each document; ``ids`` are all documents' ids, one after the other."""
    ids, lengths = np.asarray(ids), np.asarray(lengths, dtype=np.int64)
    ids = ids if ids.dtype.kind == "u" and ids.dtype.itemsize >= 4 else ids.astype(np.uint64)
    begin, sizes, doc = _layout(lengths)
    n = len(ids)
    selector = _selectors(ids, sizes)
    begins = np.zeros(n, dtype=bool)
    where, end = begin, begin + sizes  # all blocks walk on together, a word a round
    while len(where):
        begins[where] = True
        where = where + COUNTS[selector[where]]
        more = where < end
        where, end = where[more], end[more]
    first = np.flatnonzero(begins)
    sel = selector[first]
    place_of = np.searchsorted(first, begin)
    # an id beyond its block's end does not belong to the word
    held = np.diff(first, append=n)
    escape = sel == 15
    place = np.arange(len(first)) + np.cumsum(escape) - escape  # an escape takes two words
    words = np.zeros(len(first) + int(escape.sum()), dtype=np.uint64)
    for s in np.unique(sel):
        mine = np.flatnonzero(sel == s)
        if s == 15:
            long = ids[first[mine]].astype(np.uint64)
            words[place[mine]] = (long & _LOW) << np.uint64(4) | np.uint64(15)
            words[place[mine] + 1] = (long >> np.uint64(60)) << np.uint64(4) | np.uint64(14)
            continue
        short = held[mine] < COUNTS[s]
        for some, whole in ((mine[~short], True), (mine[short], False)):
            out = np.full(len(some), s, dtype=np.uint64)
            for k in range(COUNTS[s] if len(some) else 0):
                if whole:
                    value = ids[first[some] + k].astype(np.uint64)
                else:
                    inside = held[some] > k
                    value = np.where(inside, ids[np.where(inside, first[some] + k, 0)], 0).astype(np.uint64)
                out |= value << np.uint64(4 + k * BITS[s])
            words[place[some]] = out
    # word offsets of the blocks, and of the documents
    of_block = place[place_of]
    n_blocks = -(-lengths // BLOCK)
    block_at = np.concatenate([[0], np.cumsum(n_blocks)])
    raw, records = words.tobytes(), []
    for d in range(len(lengths)):
        a, b = block_at[d], block_at[d + 1]
        lo = int(of_block[a]) if b > a else 0
        hi = (int(of_block[b]) if b < len(of_block) else len(words)) if b > a else 0
        head = np.concatenate([[lengths[d], b - a], of_block[a:b] - lo]).astype("<u4").tobytes()
        records.append(head + b"\0" * (-len(head) % 8) + raw[lo * 8 : hi * 8])
    return records


def unpack(records: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the records, one after the other, and each record's number of ids."""
    lengths, words, sizes, starts, base = [], [], [], [], 0
    for r in records:
        n, n_blocks = (int(x) for x in np.frombuffer(r, "<u4", 2))
        offsets = np.frombuffer(r, "<u4", n_blocks, 8).astype(np.int64)
        w = np.frombuffer(r, "<u8", -1, -(-(8 + 4 * n_blocks) // 8) * 8)
        lengths.append(n)
        words.append(w)
        starts.append(offsets + base)
        sizes.append(np.minimum(BLOCK, n - BLOCK * np.arange(n_blocks)))
        base += len(w)
    lengths = np.array(lengths, dtype=np.int64)
    if not base:
        return np.zeros(0, dtype=np.uint64), lengths
    word, start, size = np.concatenate(words), np.concatenate(starts), np.concatenate(sizes)
    sel = (word & np.uint64(15)).astype(np.int64)
    body = word >> np.uint64(4)
    count = COUNTS[sel].copy()
    # the last word of a block may hold fewer ids than its selector says
    done = np.cumsum(count)
    before = done - count
    last = np.append(start[1:], len(word)) - 1
    last_real = last - (sel[last] == 14)
    out_end = np.cumsum(size)
    held = before[last_real] - before[start]
    count[last_real] = size - held
    place = np.cumsum(count) - count
    ids = np.zeros(int(out_end[-1]), dtype=np.uint64)
    for s in np.unique(sel):
        if s == 14:
            continue
        mine = np.flatnonzero(sel == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(COUNTS[s]):
            use = mine[count[mine] > k]
            ids[place[use] + k] = (body[use] >> np.uint64(k * BITS[s])) & mask
    rest = np.flatnonzero(sel == 14)
    ids[place[rest - 1]] |= body[rest] << np.uint64(60)
    return ids, lengths


class _Ids:
    """Ids of whole texts by the library; what this process has met is remembered.

    Texts (else chunks) of plain letters and marks are cut into pre-tokens all at once, by the rules of the
    file's own pattern; each different one is looked up once, and the library's model encodes new ones.
    """

    def __init__(self, path: str):
        self.library, self.spaced = library(path), cuts_at_space(path)
        added = self.library.get_added_tokens_decoder().values()
        self.cuts = self.spaced and cuts_by_class(path) and not any(t.normalized for t in added)
        self.model, self.added = self.library.model, [t.content for t in added]
        symbol = {b: c for c, b in byte_symbols().items()}
        self.symbols = {i: "".join([symbol[b] for b in chr(i).encode()]) for i in range(256)}
        self.known, self.words = Memory(self._one, _KEEP_CHUNKS), Memory(self._word, _KEEP_WORDS)

    def _one(self, chunk: str) -> bytes:
        return self._each([chunk])[0]

    def _each(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: bytes) -> bytes:
        """Ids of a lower-cased pre-token in Latin-1."""
        symbols = word.decode("latin-1").translate(self.symbols)
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def _plain(self, text: str) -> bytes | None:
        """The text in Latin-1 where the pattern alone gives the pre-tokens: no added token's name either."""
        raw = plain_bytes(text) if self.cuts else None
        return None if raw is None or any(name in text for name in self.added) else raw

    def _words_of(self, texts: list[bytes]) -> list[bytes]:
        """Ids of plain texts."""
        body, begins, before = cut(texts)
        if len(begins) == 1:
            return [b""] * len(texts)
        kind = pa.large_binary()
        met = pa.Array.from_buffers(kind, len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(body)]).dictionary_encode()
        of = [self.words[w] for w in met.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, of), np.int64, len(of)) // 4
        word = met.indices.to_numpy()
        n = sizes[word]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat((np.cumsum(sizes) - sizes)[word] - ends[:-1], n) + np.arange(ends[-1])
        ids, cuts = np.frombuffer(b"".join(of), "<u4")[at].tobytes(), (ends[before] * 4).tolist()
        return [ids[lo:hi] for lo, hi in zip(cuts, cuts[1:])]

    def _by(self, texts: list[str], others: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Ids of plain texts by their pre-tokens, of the rest by ``others``."""
        raw = [self._plain(t) for t in texts]
        words = iter(self._words_of([r for r in raw if r is not None]))
        rest = iter(others([t for t, r in zip(texts, raw) if r is None]))
        return [next(rest if r is None else words) for r in raw]

    def _chunked(self, texts: list[str]) -> list[bytes]:
        """Texts by their chunks between spaces."""
        split = [pieces(t, True) for t in texts]
        new = [c for c in set(chain.from_iterable(split)).difference(self.known) if c not in self.known.old]
        fresh = dict(zip(new, self._by(new, self._each)))
        out = [b"".join([fresh[c] if c in fresh else self.known[c] for c in s]) for s in split]
        for c, ids in fresh.items():
            self.known.put(c, ids)
        return out

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        return self._by(texts, self._chunked if self.spaced else self._each)


#: Pre-tokens and chunks of other texts remembered, and as many older ones.
_KEEP_WORDS, _KEEP_CHUNKS = 400_000, 100_000
_AT_ONCE = 256  # documents unpacked at once
_TEXT_BYTES = 2 << 20  # of texts encoded at once


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Ids:
    """One for the process: what a task has learnt serves the next."""
    return _Ids(path)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the files: doc_id, n_tokens, record, with part and start_in_part telling the order.

    The texts are range-partitioned, not the records: finding the range bounds runs over the shuffle's
    input once more, which must not be the encoder.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _encoder(tokenizer)
        tail = np.array([end_id], dtype="<u4").tobytes()
        part, done = TaskContext.get().partitionId(), 0
        for b in (some for whole in batches for some in slices(whole, 1, _TEXT_BYTES)):
            raw = [x + tail for x in of(b.column(1).to_pylist())]
            lengths = np.array([len(x) // 4 for x in raw], dtype=np.int64)
            records = pack(np.frombuffer(b"".join(raw), "<u4"), lengths)
            start = done + np.cumsum(lengths) - lengths
            done += int(lengths.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lengths), pa.array(records, pa.binary()), pa.array(np.full(len(lengths), part, dtype=np.int32)), pa.array(start)],
                names=["doc_id", "n_tokens", "record", "part", "start_in_part"])

    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("_h", F.xxhash64("text"))
    ordered = texts.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").select("doc_id", "text")
    ordered.mapInArrow(encode, f"doc_id {kind}, n_tokens bigint, record binary, part int, start_in_part bigint").write.option(
        "compression", "none").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids, decoded from the files."""
    return _decode(spark, folder, "ids array<bigint>", lambda ids: ids.astype(np.int64), pa.list_(pa.int64()))


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    return _decode(spark, folder, "ids_crc32 bigint", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())


def _decode(spark: SparkSession, folder: str, field: str, result, out: pa.DataType) -> DataFrame:
    files = spark.read.parquet(folder)
    kind = files.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _AT_ONCE):
                b = whole.slice(at, _AT_ONCE)
                ids, lengths = unpack(b.column(3).to_pylist())
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3], pa.array(lengths), pa.array([result(ids[e - n : e]) for e, n in zip(ends, lengths)], out)],
                    names=["doc_id", "part", "start_in_part", "n_tokens", field.split()[0]])

    rows = files.select("doc_id", "part", "start_in_part", "record").mapInArrow(
        run, f"doc_id {kind}, part int, start_in_part bigint, n_tokens bigint, {field}")
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))  # a row for each written partition
    before = parts.select("part", F.coalesce(F.sum("_n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("_before") + F.col("start_in_part")).alias("start"), "n_tokens", field.split()[0])
