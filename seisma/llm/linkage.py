"""Linking of similar sets: shared keys, bounded cells, exact check, components.

``members`` groups ids by the smallest id that shares a key with them, so a key
of a million ids makes a million rows, not their pairs.  ``links`` deals each
group into cells of at most ``2 * block`` sets; a cell is a block of the product
of the set-by-element incidence matrix with its transpose, accumulated over
chunks of elements, and hands out a spanning forest of its links.
``components`` contracts links until none is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seisma.llm.tables import small, stored

BLOCK = 256
_COLUMNS = 8192


def shared_keys(postings: DataFrame) -> DataFrame:
    """(key, pivot) of the keys that two different ids have; partial sums leave one row a key and task."""
    ends = postings.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("_last"))
    return stored(ends.where(F.col("pivot") != F.col("_last")).select("key", "pivot"))


def members(postings: DataFrame) -> DataFrame:
    """Distinct (pivot, id): ids that share a key also share that key's pivot."""
    return postings.join(small(shared_keys(postings)), "key").select("pivot", "id").distinct()


def _product(sets: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of all pairs of sorted distinct arrays, chunk of elements after chunk."""
    m = len(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    _, columns, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    use = seen[columns] > 1
    rows, columns = rows[use], columns[use]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    columns = np.cumsum(np.r_[0, (np.diff(columns) != 0).astype(np.int64)]) if len(columns) else columns
    counts = np.zeros((m, m), dtype=np.float32)
    width = int(columns[-1]) + 1 if len(columns) else 0
    for at in range(0, width, _COLUMNS):
        a, b = np.searchsorted(columns, [at, at + _COLUMNS])
        chunk = np.zeros((m, min(_COLUMNS, width - at)), dtype=np.float32)
        chunk[rows[a:b], columns[a:b] - at] = 1
        counts += chunk @ chunk.T
    return counts.astype(np.int64)


def forest(ids: list, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Spanning links (smaller id, larger id) of the pairs whose Jaccard similarity reaches ``percent``.

    Where two sides meet, only pairs across them count; pairs of one side have a cell of their own.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if len(ids) < 2:
        return []
    low, high = np.minimum(sizes[:, None], sizes[None, :]), np.maximum(sizes[:, None], sizes[None, :])
    may = np.triu(100 * low >= percent * high, 1)  # overlap cannot pass the smaller size
    if sides.min() != sides.max():
        may &= sides[:, None] != sides[None, :]
    busy = np.flatnonzero(may.any(axis=0) | may.any(axis=1))
    if not len(busy):
        return []
    may, sizes = may[np.ix_(busy, busy)], sizes[busy]
    both = _product([sets[i] for i in busy])
    linked = may & (100 * both >= percent * (sizes[:, None] + sizes[None, :] - both))
    parent = list(range(len(busy)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
        a, b, x, y = root(i), root(j), ids[busy[i]], ids[busy[j]]
        if a != b and x != y:
            parent[a] = b
            out.append((min(x, y), max(x, y)))
    return out


def as_numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def links(groups: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK, read: Callable[..., np.ndarray] = as_numbers) -> DataFrame:
    """(a, b) links that connect all pairs of a group whose similarity reaches ``percent``.

    ``groups`` has (pivot, id), ``sets`` (id, elements); ``read`` makes a sorted array of distinct
    unsigned 64-bit values out of elements.
    """
    kind, pivot_kind = (groups.schema[c].dataType for c in ("id", "pivot"))
    sizes = groups.groupBy("pivot").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    dealt = (
        groups.join(sizes, "pivot")
        .withColumn("_parts", F.ceil(F.col("_n") / block).cast("int"))
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
        .join(sets, "id")
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .select("pivot", F.least("side", "_other").alias("lo"), F.greatest("side", "_other").alias("hi"), "side", "id", "elements")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import chain

        now, ids, sides, sets_, out = None, [], [], [], []

        def rows() -> Iterator[tuple]:
            for b in batches:
                yield from zip(zip(*(b.column(i).to_pylist() for i in range(3))), *(b.column(i).to_pylist() for i in (3, 4, 5)))

        for key, side, id_, raw in chain(rows(), [(None, None, None, None)]):
            if key != now:
                out += forest(ids, np.array(sides), [read(x) for x in sets_], percent) if len(ids) > 1 else []
                now, ids, sides, sets_ = key, [], [], []
                if len(out) >= 10_000 or key is None and out:
                    yield pa.RecordBatch.from_pydict({"a": [x for x, _ in out], "b": [y for _, y in out]})
                    out = []
            if key is not None:
                ids.append(id_)
                sides.append(side)
                sets_.append(raw)

    cells = dealt.repartition("pivot", "lo", "hi").sortWithinPartitions("pivot", "lo", "hi")
    return cells.mapInArrow(run, f"a {kind.simpleString()}, b {pivot_kind.simpleString()}").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): every id of a link with the smallest id it reaches.

    Each round points every id at its smallest neighbour, follows the pointers
    to their ends (doubling their reach each time), and moves the links to
    those; links inside a component vanish.  A round needs grouped minima and
    joins only, and no step gathers a component.
    """
    edges = stored(edges.where(F.col("a") != F.col("b")))
    found = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct().select("id", F.col("id").alias("component"))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("n"), F.least("a", "b").alias("p")))
        while True:
            further = stored(up.select("n", F.col("p").alias("_p")).join(up.select(F.col("n").alias("_p"), "p"), "_p").select("n", "p", (F.col("p") != F.col("_p")).alias("moved")))
            up = further.select("n", "p")
            if further.where("moved").isEmpty():
                break
        found = stored(found.join(up, found["component"] == up["n"], "left").select("id", F.coalesce("p", "component").alias("component")))
        edges = stored(
            edges.join(up.select(F.col("n").alias("a"), F.col("p").alias("_a")), "a")
            .join(up.select(F.col("n").alias("b"), F.col("p").alias("_b")), "b")
            .where(F.col("_a") != F.col("_b")).select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())
    return found
