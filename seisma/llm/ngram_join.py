"""N-gram Jaccard self-join by a blocked sparse matrix product.

Documents are rows and word n-grams columns of a sparse 0/1 matrix; the join
wants the pairs of rows whose overlap in the product with the transpose reaches
the Jaccard bound.  Size-derived bounds leave out rows and pairs that cannot
reach it, and all of them are exact:

1. Equal sets are one row; the smallest doc_id stands for them.
2. In any fixed order of columns, two similar rows with ``a(n) = ceil(t n)`` share
   at least ``k`` of their first ``n - a(n) + k`` columns.  A row with fewer
   shared columns among those has no partner and is left out; this is done with
   ``k = n / 20`` for all rows, then with ``k = 3 n / 10`` for those that remain.
3. Among the remaining rows, columns are ordered by how often they occur, as a
   table of ``BUCKETS`` counts tells (its size is fixed, any order is exact, and
   rare columns first make small groups); similar rows share one of the first
   ``n - a(n) + 1``, and rows that share one come together in a group.
4. Groups are dealt into bounded blocks, the product is accumulated block by
   block over chunks of columns, pairs of sizes too far apart are discarded,
   and the exact bound decides (``linkage``).

Defined results: words are cut at ASCII white space after lower-casing A-Z; a
null or empty text has no n-grams and links with nothing; fewer words than n
are one n-gram; repeated rows of one doc_id are one document; a null doc_id is
its own component and links with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from seisma.llm import linkage
from seisma.llm.shingles import mix, signed, word_shingles
from seisma.llm.tables import slices, small, stored, tidy, utf8

NGRAM = 3
PERCENT = 90


def _least(n, percent: int):
    """The overlap that a row of n columns needs at least, whatever its partner."""
    return (percent * n + 99) // 100


#: Share of a row's columns that each filter asks to be shared, as a fraction.
FILTERS = ((1, 20), (3, 10))
BUCKETS = 1 << 19
_PARTS = 64
#: Keys that a task of a filter gathers before it sends them, and keys that one part of the filter compares.
CHUNK_KEYS = 1 << 19
PART_KEYS = 1 << 20


def _rows(docs: DataFrame, ngram: int, percent: int, share: tuple[int, int]) -> DataFrame:
    """doc_id, n, two halves of the set's digest, and the first columns in hash order that the filter looks at."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 1)):
            n, high, low, first = [], [], [], []
            for raw in utf8(b.column(1)):
                s = word_shingles(raw, ngram)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                first.append(signed(s[: len(s) - _least(len(s), percent) + max(1, len(s) * share[0] // share[1])]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(first, pa.list_(pa.int64()))],
                names=["doc_id", "n", "high", "low", "first"])

    return docs.mapInArrow(tidy(run), f"doc_id {kind}, n bigint, high bigint, low bigint, first array<bigint>")


def _sets(docs: DataFrame, ngram: int) -> DataFrame:
    """id and elements (sorted distinct n-gram hashes as bytes)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 1)):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([word_shingles(raw, ngram).tobytes() for raw in utf8(b.column(1))], pa.binary())], names=["id", "elements"])

    return docs.mapInArrow(tidy(run), f"id {kind}, elements binary")


def _classes(n: np.ndarray, percent: int) -> np.ndarray:
    """Size classes: two sizes that the bound allows together lie in one class or in neighbours (a little room for rounding)."""
    return np.floor(np.log(np.maximum(n, 1)) / np.log(100 / percent * (1 + 1e-9))).astype(np.int64)


def _met(keys: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Which entries share their key with another entry of the same or a neighbouring class."""
    order = np.lexsort((classes, keys))
    k, c = keys[order], classes[order]
    near = (k[1:] == k[:-1]) & (c[1:] - c[:-1] <= 1)
    out = np.zeros(len(keys), dtype=bool)
    out[order] = np.r_[near, False] | np.r_[False, near]
    return out


def _requests(ids: pa.Array, n: np.ndarray, owners: np.ndarray, keys: np.ndarray, parts: int, percent: int) -> pa.RecordBatch:
    """One chunk's keys as a row a part; keys met inside the chunk go once a size class, without owner."""
    classes = _classes(n, percent)[owners]
    met = _met(keys, classes)
    counts = np.bincount(owners[met], minlength=len(ids))
    here = np.flatnonzero(counts)
    _, once = np.unique(np.stack([keys[met].view(np.int64), classes[met]]), axis=1, return_index=True)
    use = np.sort(np.r_[np.flatnonzero(~met), np.flatnonzero(met)[once]])
    keys, owners, met = keys[use], owners[use], met[use]
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((owners, met, part))
    keys, owners, met, part = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")[order], owners[order], met[order], part[order]
    ends = np.flatnonzero(np.r_[part[1:] != part[:-1], len(part) > 0])
    # the first row hands over what the chunk itself has counted; any part will do for it
    rows = [(int(keys[0]) % parts if len(keys) else 0, here, counts[here].astype("<u4").tobytes(), None, b"")]
    lo = 0
    for hi in (ends + 1).tolist():
        own = lo + int(np.searchsorted(met[lo:hi], True))
        first = np.flatnonzero(np.r_[True, owners[lo + 1 : own] != owners[lo : own - 1]]) if own > lo else np.zeros(0, np.int64)
        runs = np.diff(np.r_[first, own - lo]).astype("<u4")
        rows.append((int(part[lo]), owners[lo:own][first], runs.tobytes(), keys[lo:hi].tobytes(), n[owners[own:hi]].astype("<u4").tobytes()))
        lo = hi
    who = np.concatenate([r[1] for r in rows])
    at = np.cumsum([0] + [len(r[1]) for r in rows])
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), ids.take(pa.array(who, pa.int64()))),
         pa.array([n[r[1]].astype("<u4").tobytes() for r in rows], pa.binary())] + [pa.array([r[i] for r in rows], pa.binary()) for i in (2, 3, 4)],
        names=["part", "ids", "n", "runs", "keys", "more"])


def _busy(rows: DataFrame, percent: int, share: tuple[int, int]) -> DataFrame:
    """doc_id of the rows that share enough of their first columns with rows of a size that the bound allows.

    Keys travel as 32 bits beside the part that the other bits name, about ``PART_KEYS`` to a part at every
    size of input; keys that fall together there only keep more rows.  A key met inside a chunk of
    ``CHUNK_KEYS`` travels once a size class, so a key of all rows adds a few entries a chunk.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    total = rows.agg(F.sum(F.size("first"))).first()[0] or 0
    parts = max(1, -(-total // PART_KEYS))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, n, lengths, keys, held = [], [], [], [], 0

        def chunk() -> pa.RecordBatch:
            owners = np.repeat(np.arange(sum(map(len, n))), np.concatenate(lengths))
            return _requests(pa.concat_arrays(ids), np.concatenate(n), owners, np.concatenate(keys), parts, percent)

        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                ids.append(b.column(0))
                n.append(b.column(1).to_numpy())
                lengths.append(b.column(2).value_lengths().to_numpy())
                keys.append(b.column(2).flatten().to_numpy().view(np.uint64))
                held += len(keys[-1])
                if held >= CHUNK_KEYS:
                    yield chunk()
                    ids, n, lengths, keys, held = [], [], [], [], 0
        if ids:
            yield chunk()

    def answer(table: pa.Table) -> pa.Table:
        ids, n, counts, owners, keys, sizes, at = [], [], [], [], [], [], 0
        for i in range(table.num_rows):
            own, size, runs = table.column("ids")[i].values, *(np.frombuffer(table.column(c)[i].as_py(), "<u4") for c in ("n", "runs"))
            ids.append(own)
            n.append(size)
            sent = table.column("keys")[i].as_py()
            if sent is None:
                counts.append((at, runs))
            else:
                more = np.frombuffer(table.column("more")[i].as_py(), "<u4")
                keys.append(np.frombuffer(sent, "<u4"))
                sizes += [np.repeat(size, runs), more]
                owners += [np.repeat(np.arange(at, at + len(own)), runs), np.full(len(more), -1)]
            at += len(own)
        shared = np.zeros(at, dtype=np.int64)
        if keys:
            who = np.concatenate(owners)
            met = _met(np.concatenate(keys), _classes(np.concatenate(sizes), percent)) & (who >= 0)
            shared += np.bincount(who[met], minlength=at)
        for start, runs in counts:
            shared[start : start + len(runs)] += runs
        keep = pa.array(shared > 0)
        return pa.table({"id": pa.concat_arrays(ids).filter(keep), "n": pa.array(np.concatenate(n).astype(np.int64)).filter(keep), "shared": pa.array(shared).filter(keep)})

    asked = rows.select("doc_id", "n", "first").mapInArrow(tidy(ask), f"part int, ids array<{kind}>, n binary, runs binary, keys binary, more binary")
    shared = asked.groupBy("part").applyInArrow(answer, f"id {kind}, n bigint, shared bigint")
    shared = shared.groupBy("id").agg(F.sum("shared").alias("_shared"), F.max("n").alias("n"))
    # a partner may be smaller, down to the least overlap, and then looks at fewer columns
    fewest = F.floor(F.floor((F.col("n") * percent + 99) / 100) * share[0] / share[1])
    return stored(shared.where(F.col("_shared") >= F.greatest(F.lit(1), fewest)).select(F.col("id").alias("doc_id")))


def _frequencies(sets: DataFrame) -> np.ndarray:
    """How many elements fall into each of ``BUCKETS`` hash buckets, over all sets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            for raw in b.column(0).to_pylist():
                np.add.at(counts, (np.frombuffer(raw, "<u8") & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        parts = counts.reshape(_PARTS, -1)
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(_PARTS), pa.int32()), "counts": pa.array([p.tobytes() for p in parts], pa.binary())})

    def total(part: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x, np.int64) for x in part.column("counts").to_pylist())
        return pa.table({"part": part.column("part").slice(0, 1), "counts": pa.array([counts.tobytes()], pa.binary())})

    schema = "part int, counts binary"
    rows = sets.select("elements").mapInArrow(count, schema).groupBy("part").applyInArrow(total, schema).collect()  # _PARTS rows
    out = np.zeros((_PARTS, BUCKETS // _PARTS), dtype=np.int64)
    for r in rows:
        out[r.part] = np.frombuffer(r.counts, np.int64)
    return out.reshape(-1)


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """(id, key) of each row's rarest columns, as many as the least overlap asks for, once for the row's size class and once for the next.

    Rows of sizes that the bound allows together share such a key; rows too far apart in size share none.
    """
    kind = sets.schema["id"].dataType.simpleString()
    shared = sets.sparkSession.sparkContext.broadcast(_frequencies(sets))  # 8 * BUCKETS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for b in batches:
            keys = []
            for raw in b.column(1).to_pylist():
                s = np.frombuffer(raw, "<u8")
                order = np.argsort(often[(s & np.uint64(BUCKETS - 1)).astype(np.int64)], kind="stable")  # ties in hash order
                rare, own = s[order[: len(s) - _least(len(s), percent) + 1]], _classes(np.array([len(s)]), percent).view(np.uint64)
                keys.append(signed(mix(np.concatenate([rare ^ mix(own), rare ^ mix(own + np.uint64(1))]))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["id", "keys"])

    return sets.mapInArrow(tidy(run), f"id {kind}, keys array<bigint>").select("id", F.explode("keys").alias("key"))


def join(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included)."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = stored(_rows(texts, ngram, percent, FILTERS[0]))
    real = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stored(real.groupBy("high", "low").agg(F.min("doc_id").alias("rep")))
    copies = stored(real.select("doc_id", "high", "low").join(classes, ["high", "low"]).where(F.col("rep") != F.col("doc_id")).select("doc_id"))

    busy = _busy(real.join(small(copies), "doc_id", "left_anti"), percent, FILTERS[0])
    for share in FILTERS[1:]:
        busy = _busy(stored(_rows(texts.join(small(busy), "doc_id", "left_semi"), ngram, percent, share)), percent, share)
    sets = stored(_sets(texts.join(small(busy), "doc_id", "left_semi"), ngram))
    postings = stored(_postings(sets, percent))

    found = linkage.components(linkage.links(linkage.members(postings), sets, percent))
    named = rows.select("doc_id", "n", "high", "low").join(classes, ["high", "low"], "left")
    named = named.join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
    own = (F.col("n") == 0) | F.col("doc_id").isNull()
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(own, F.col("doc_id")).otherwise(F.coalesce("component", "rep")).alias("component_id"))


def keep_one(docs: DataFrame, ngram: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are the smallest doc_id of their component, all columns unchanged."""
    found = join(docs, ngram, percent, doc_id, text)
    gone = stored(found.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias(doc_id)).distinct())
    return docs.join(small(gone), doc_id, "left_anti").select(docs.columns)
