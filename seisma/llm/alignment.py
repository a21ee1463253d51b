"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a
sentencepiece model that puts a space in front of a text; both are laid over
the bytes of space + text.  Within a batch of documents two
``pandas.merge_asof`` joins, keyed by document, find for each token's start the
token of the other side that covers it; both directions together are all pairs
of tokens that overlap.  Offsets where tokens of both sides end cut the tokens
into groups.

How many documents hold a pair of ids linked is a corpus-wide count.  A batch
keeps its links as places in its own sorted list of pairs, and sends only that
list with the batch's document counts into the shuffle; the totals come back by
a join and are looked up in place.  So a pair that occurs everywhere moves as one
row a batch, and no table of pairs is ever held whole.

Text is encoded in chunks cut before a space that follows something else than
white space: the byte-level splitter always cuts there, and so does the model
if no piece of its vocabulary has a space after another character (checked,
with whole texts as the other way).  Short chunks are remembered by the worker.

Defined results: a null or empty text, and one whose tokens do not give back
its bytes, has no tokens and no links, zero counts and an empty digest;
repeated rows count as documents of their own; other columns are left aside;
an empty table gives none.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from seisma.llm.chunks import byte_symbols
from seisma.llm.tables import written

#: Text that is aligned at once, and text whose links share a list of pairs, in bytes (a longer document is one by itself).
SLICE_BYTES = 2 << 20
BATCH_BYTES = 16 << 20
#: Chunks of up to so many characters are remembered, so many of them and as many older ones.
CHUNK_CHARS = 48
CHUNKS = 150_000

_CUT = re.compile(r"(?<=\S)(?= )")
_RUN = re.compile(r"\s ")


class Pair:
    """Both encoders and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core only
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        symbol = byte_symbols()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(symbol[c] for c in token) if all(c in symbol for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(t) for t in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        n, m = len(self.a_bytes), len(self.b_bytes)
        self.n_b = m  # a pair of ids is a * n_b + b
        if n * m >= 1 << 31:
            raise ValueError("vocabularies too large for 32-bit pairs")
        self.names = [f"{i}{end}" for size, ends in ((n, ",|"), (m, ",;")) for end in ends for i in range(size)]
        self.name_at = {"a,": 0, "a|": n, "b,": 2 * n, "b;": 2 * n + m}
        self.new: dict[str, Any] = {}
        self.old: dict[str, Any] = {}
        self.space = [pieces.index("▁")] if "▁" in pieces else []
        self.cuts = not any(" " in p.replace("▁", " ").lstrip(" ") for p in pieces) and self._probe()

    def _probe(self) -> bool:
        """Whether chunks encode as they do inside a text, on a text of the kinds that matter."""
        text = " a b  c\n d, é中 x  y\t z's  "
        whole = self._fresh([" " + text])[0][:2]
        parts = self._fresh(_CUT.split(" " + text))
        return whole == (b"".join(p[0] for p in parts), b"".join(p[1] for p in parts))

    def _fresh(self, chunks: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Ids of both sides (32 bits each) and whether both give back the chunk's bytes; a chunk begins with a space."""
        out = []
        for chunk, e, ids in zip(chunks, self.a.encode_batch_fast(chunks, add_special_tokens=False), self.b.encode([c[1:] for c in chunks], num_threads=1)):
            ids = ids or self.space  # the model gives nothing for an empty text
            raw = chunk.encode()
            same = b"".join([self.a_bytes[i] for i in e.ids]) == raw and b"".join([self.b_bytes[i] for i in ids]) == raw
            out.append((np.array(e.ids, "<i4").tobytes(), np.array(ids, "<i4").tobytes(), same))
        return out

    def chunks(self, text: str) -> list[str]:
        """Pieces of space + text, each beginning with a space."""
        if not self.cuts:
            return [" " + text]
        if _RUN.search(" " + text):
            return _CUT.split(" " + text)
        return [" " + w for w in text.split(" ")]

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Ids of both sides of each text; texts whose bytes do not come back have none."""
        split = [self.chunks(t) if t else [] for t in texts]
        if len(self.new) > CHUNKS:
            self.old, self.new = self.new, {}
        here, get = {}, self.old.get
        missing = []
        for c in set(chain.from_iterable(split)).difference(self.new):
            got = get(c)
            if got is None:
                missing.append(c)
            else:
                self.new[c] = got
        for c, got in zip(missing, self._fresh(missing)):
            (self.new if len(c) <= CHUNK_CHARS else here)[c] = got
        a_ids, b_ids = [], []
        for t, s in zip(texts, split):
            got = [self.new.get(c) or here[c] for c in s] if here else [self.new[c] for c in s]
            a, b = b"".join([g[0] for g in got]), b"".join([g[1] for g in got])
            if not all([g[2] for g in got]):
                a, b, same = self._fresh([" " + t])[0]  # the whole text decides
                a, b = (a, b) if same else (b"", b"")
            a_ids.append(a)
            b_ids.append(b)
        return a_ids, b_ids


@lru_cache(maxsize=2)
def pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def overlaps(doc_a: np.ndarray, len_a: np.ndarray, doc_b: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (token of A, token of B) whose bytes overlap; both sides cover the same bytes of the same documents."""
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    a = pd.DataFrame({"doc": doc_a, "at": end_a - len_a, "a": np.arange(len(doc_a))})
    b = pd.DataFrame({"doc": doc_b, "at": end_b - len_b, "b": np.arange(len(doc_b))})
    over_a = pd.merge_asof(a, b, on="at", by="doc")["b"].to_numpy()
    # equal starts have been found from A's side; what is left begins strictly inside a token of A
    over_b = pd.merge_asof(b, a, on="at", by="doc", allow_exact_matches=False)["a"].to_numpy()
    inside = np.flatnonzero(~np.isnan(over_b)) if over_b.dtype.kind == "f" else np.arange(len(over_b))
    found = over_b[inside].astype(np.int64)
    covers = end_a[found] > b["at"].to_numpy()[inside]
    return np.concatenate([np.arange(len(doc_a)), found[covers]]), np.concatenate([over_a.astype(np.int64), inside[covers]])


def _align(p: Pair, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray]:
    """Counts by document, digests of the groups, and each document's distinct pairs (document << 32 | pair) with their times."""
    raw_a, raw_b = p.encode(texts)
    n = len(texts)
    n_a, n_b = (np.array([len(x) // 4 for x in raw], dtype=np.int64) for raw in (raw_a, raw_b))
    a, b = (np.frombuffer(b"".join(raw), "<i4").astype(np.int64) for raw in (raw_a, raw_b))
    none = {"n_a": n_a, "n_b": n_b, "n_groups": np.zeros(n, np.int64), "n_links": np.zeros(n, np.int64)}
    if not len(a):
        return none, [""] * n, np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    left, right = overlaps(doc_a, p.a_len[a], doc_b, p.b_len[b])
    pairs, times = np.unique(doc_a[left] << 32 | a[left] * p.n_b + b[right], return_counts=True)
    # groups: cut where tokens of both sides end
    end_a, end_b = np.cumsum(p.a_len[a]), np.cumsum(p.b_len[b])
    cut_a = end_b[np.searchsorted(end_b, end_a)] == end_a
    cut_b = end_a[np.searchsorted(end_a, end_b)] == end_b
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    in_a, in_b = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.concatenate([[0], in_b])[group_a]] = a + np.where(cut_a, p.name_at["a|"], p.name_at["a,"])
    order[np.arange(len(b)) + in_a[group_b]] = b + np.where(cut_b, p.name_at["b;"], p.name_at["b,"])
    name, ends, digests = p.names.__getitem__, np.cumsum(n_a + n_b), []
    for lo, hi in zip(ends - n_a - n_b, ends):
        digests.append(hashlib.sha256("".join(map(name, order[lo:hi].tolist()))[:-1].encode()).hexdigest() if hi > lo else "")
    return {**none, "n_groups": np.bincount(doc_a[cut_a], minlength=n), "n_links": np.bincount(doc_a[left], minlength=n)}, digests, pairs, times


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([pa.compress(x.astype("<i4").tobytes(), codec="zstd", asbytes=True)], pa.binary())


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, n * 4, codec="zstd", asbytes=True), "<i4")


def batches(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", slice_bytes: int = SLICE_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A row for each batch of documents: their counts and digests, their links as places in the batch's list of
    pairs, and that list with the number of the batch's documents that hold each pair."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def finish(number: int, parts: list) -> pa.RecordBatch:
        ids = pa.concat_arrays([x[0] for x in parts])
        base = np.cumsum([0, *(len(x[0]) for x in parts)])
        keys = np.concatenate([x[3] + (int(k) << 32) for x, k in zip(parts, base)])
        pairs, at, held = np.unique(keys & 0xFFFFFFFF, return_inverse=True, return_counts=True)
        return pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId() << 32 | number], pa.int64()), _list(ids),
            *(_list(pa.array(np.concatenate([x[1][c] for x in parts]), pa.int64())) for c in _COUNTS),
            _list(pa.array([d for x in parts for d in x[2]], pa.string())),
            _list(pa.array(np.bincount(keys >> 32, minlength=len(ids)), pa.int64())),
            _packed(at), _packed(np.concatenate([x[4] for x in parts])),
            _list(pa.array(pairs, pa.int32())), _list(pa.array(held, pa.int32())),
        ], names=["batch", "doc_id", *_COUNTS, "groups_sha256", "n_pairs", "at", "times", "pair", "held"])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(a_path, b_path)
        parts, size, number = [], 0, 0
        for b in source:
            column = b.column(1)
            bytes_ = np.array([0 if v is None else v for v in pa.compute.binary_length(column).to_pylist()], dtype=np.int64)
            lo = 0
            while lo < b.num_rows:
                hi = lo + max(1, int(np.searchsorted(np.cumsum(bytes_[lo:]), slice_bytes, "right")))
                parts.append((b.column(0).slice(lo, hi - lo), *_align(p, column.slice(lo, hi - lo).to_pylist())))
                size += int(bytes_[lo:hi].sum())
                lo = hi
                if size >= batch_bytes:
                    yield finish(number, parts)
                    parts, size, number = [], 0, number + 1
        if parts:
            yield finish(number, parts)

    lists = ", ".join(f"{c} array<bigint>" for c in _COUNTS)
    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(run, (
        f"batch bigint, doc_id array<{kind}>, {lists}, groups_sha256 array<string>, n_pairs array<bigint>, at binary, times binary, pair array<int>, held array<int>"))


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    kind = docs.schema[doc_id].dataType.simpleString()
    made = written(batches(docs, a_path, b_path, doc_id, text, **sizes), "alignment")
    n_b = pair(a_path, b_path).n_b
    held = made.select(F.col("batch").alias("of"), F.explode(F.arrays_zip("pair", "held")).alias("x")).select("of", F.col("x.pair").alias("pair"), F.col("x.held").alias("held"))
    totals = held.groupBy("pair").agg(F.sum("held").alias("n")).withColumn("a", F.expr(f"pair div {n_b}"))
    best = totals.groupBy(F.col("a").alias("_a")).agg(F.max("n").alias("top"))  # a row for each id of A's vocabulary
    totals = totals.join(F.broadcast(best), F.col("a") == F.col("_a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    counted = held.select("of", "pair").join(totals, "pair").select("of", "pair", "n", "best")

    def look_up(batch: pa.Table, found: pa.Table) -> pa.Table:
        n_pairs = np.asarray(batch.column("n_pairs")[0].values)
        m = int(n_pairs.sum())
        at, times = (_unpacked(batch.column(c)[0].as_py(), m).astype(np.int64) for c in ("at", "times"))
        order = np.argsort(np.asarray(found.column("pair")))  # the batch's list is sorted by pair
        n, top = np.asarray(found.column("n"))[order], np.asarray(found.column("best"))[order]
        def total(x: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(x)])
            ends = np.cumsum(n_pairs)
            return sums[ends] - sums[ends - n_pairs]

        return pa.table([
            batch.column("doc_id")[0].values, *(batch.column(c)[0].values for c in _COUNTS),
            pa.array(total(times * top[at]), pa.int64()), pa.array(total(times * n[at]), pa.int64()), batch.column("groups_sha256")[0].values,
        ], names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    rows = made.drop("pair", "held").groupBy("batch").cogroup(counted.groupBy("of"))
    return rows.applyInArrow(look_up, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string")
