"""Nearest neighbours by a forest of random-projection trees.

Equal vectors are one point that carries its smallest ids, so a vector held by a
third of all rows costs one point.  Points are dealt into blocks of about
``BLOCK_POINTS``; each block grows ``TREES`` balanced trees whose nodes split at
the median of a projection onto the difference of two random members.  Every
point is in one leaf of each tree.

A query walks all trees of a block through one priority queue: a leaf's key is
the sum of the squared distances to the splits that the path to it crosses, and
leaves are taken in rising order of the key, over all trees together, until
they hold ``SHARE`` of the block's points, ``LEAST`` points at least.  (Keys never fall along a path, so the queue's
order is the sorted order of the leaf keys, which is taken for all queries at
once.)  The distinct points of those leaves are ranked exactly, by the inner
product of the original vectors in double precision, and the blocks' best are
merged.

Queries are dealt into blocks too, so no task holds more than a block of points
and ``BLOCK_QUERIES`` queries.

Defined results: a null id, a null, empty or zero vector, and one with null or
non-finite components take no part; vectors of another length than the query's
are no candidates; ties go to the smaller id; with fewer candidates than wanted
all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seisma.llm.tables import stored

TREES = 24
LEAF = 64
SHARE = 0.5
LEAST = 2048
BLOCK_POINTS = 16_384
BLOCK_QUERIES = 8_192
_SALTS = 4096


class Forest:
    """Balanced trees over the rows of ``points``."""

    def __init__(self, points: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 5):
        rng = np.random.default_rng(seed)
        n = len(points)
        self.points, self.depth = points, max(0, ceil(np.log2(max(1, n) / leaf)))
        self.leaves, self.directions, self.cuts = [], [], []
        for _ in range(trees if self.depth else 1):
            order, bounds = np.arange(n), np.array([0, n])
            directions, cuts = [], []
            for _ in range(self.depth):
                sizes = np.diff(bounds)
                a = order[bounds[:-1] + (rng.random(len(sizes)) * sizes).astype(int)]
                b = order[bounds[:-1] + (rng.random(len(sizes)) * sizes).astype(int)]
                d = points[a] - points[b]
                flat = np.linalg.norm(d, axis=1) < 1e-12
                d[flat] = rng.standard_normal((int(flat.sum()), points.shape[1]))
                d /= np.linalg.norm(d, axis=1, keepdims=True)
                node = np.repeat(np.arange(len(sizes)), sizes)
                height = np.einsum("ij,ij->i", points[order], d[node])
                by = np.lexsort((order, height, node))
                order, height = order[by], height[by]
                middle = bounds[:-1] + sizes // 2
                cuts.append((height[np.maximum(middle - 1, 0)] + height[np.minimum(middle, n - 1)]) / 2)
                directions.append(d)
                bounds = np.sort(np.concatenate([bounds, middle]))
            self.leaves += [order[x:y] for x, y in zip(bounds, bounds[1:])]
            self.directions.append(directions)
            self.cuts.append(cuts)

    def keys(self, queries: np.ndarray) -> np.ndarray:
        """For each query and leaf the squared distances to the crossed splits on the way, summed (0: its own leaf)."""
        out = []
        for directions, cuts in zip(self.directions, self.cuts):
            key = np.zeros((len(queries), 1))
            for d, c in zip(directions, cuts):
                over = queries @ d.T - c
                key = np.stack([key + np.maximum(over, 0) ** 2, key + np.maximum(-over, 0) ** 2], axis=2).reshape(len(queries), -1)
            out.append(key)
        return np.concatenate(out, axis=1)

    def candidates(self, queries: np.ndarray, share: float = SHARE, least: int = LEAST) -> Iterator[np.ndarray]:
        """For each query the distinct rows of the leaves that the queue gives out."""
        want = min(len(self.points), max(least, share * len(self.points)))
        sizes = np.array([len(x) for x in self.leaves])
        flat = np.concatenate(self.leaves) if self.leaves else np.zeros(0, dtype=int)
        starts = np.cumsum(sizes) - sizes
        keys = self.keys(queries)
        for order in np.argsort(keys, axis=1, kind="stable"):
            seen = np.zeros(len(self.points), dtype=bool)
            took = 0
            while took < len(order) and np.count_nonzero(seen) < want:
                # as many leaves at once as are missing at least; the queue goes on behind them
                missing = want - np.count_nonzero(seen)
                step = max(1, int(missing // max(1, sizes.max())))
                for leaf in order[took : took + step]:
                    seen[flat[starts[leaf] : starts[leaf] + sizes[leaf]]] = True
                took += step
            yield np.flatnonzero(seen)


def _best(points: np.ndarray, members: list[list[int]], queries: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """The k best (score, id) of each query among the points' ids, ties to the smaller id."""
    forest, out = Forest(points), []
    for at in range(0, len(queries), 512):
        part = queries[at : at + 512]
        for q, rows in zip(part, forest.candidates(part)):
            score = points[rows] @ q
            if len(rows) > k:
                edge = np.partition(score, len(score) - k)[len(score) - k]
                near = score >= edge - 1e-12  # near ties stay for the exact order
                rows = rows[near]
            exact = (points[rows] * q).sum(axis=1)
            out.append(sorted(((float(s), i) for s, r in zip(exact, rows) for i in members[r]), key=lambda x: (-x[0], x[1]))[:k])
    return out


def search(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row that ``is_query`` (a Column on the id) picks."""
    spark = vectors.sparkSession
    raw = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = raw.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(sound, F.lit(False)))
    rows = rows.withColumn("q", is_query(F.col("vec_id")))
    # k + 1 smallest ids of each distinct vector, in two steps so that no group is large
    some = rows.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS)).alias("_s")).agg(
        F.slice(F.array_sort(F.collect_set("vec_id")), 1, k + 1).alias("ids"), F.max("q").alias("q"))
    points = stored(some.groupBy("v").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"), F.max("q").alias("q")))
    n, n_queries = points.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("q").cast("int")), F.lit(0))).first()
    blocks, chunks = max(1, ceil(n / BLOCK_POINTS)), max(1, ceil(n_queries / BLOCK_QUERIES))
    key = F.xxhash64("v")
    to_points = points.select(F.size("v").alias("d"), F.pmod(key, F.lit(blocks)).cast("int").alias("b"), "v", "ids")
    to_points = to_points.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    queries = points.where("q").select(F.size("v").alias("d"), F.pmod(F.xxhash64("v", F.lit(1)), F.lit(chunks)).cast("int").alias("c"), "v")
    queries = queries.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
        return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = _best(matrix(left.column("v"), left.num_rows), left.column("ids").to_pylist(), matrix(right.column("v"), right.num_rows), k + 1)
        entry = pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())]))
        return pa.table({
            "v": right.column("v") if found else pa.array([], pa.list_(pa.float64())),
            "near": pa.array([[{"score": s, "vec_id": i} for s, i in x] for x in found], entry)})

    per_block = to_points.groupBy("d", "b", "c").cogroup(queries.groupBy("d", "b", "c")).applyInArrow(
        run, "v array<double>, near array<struct<score:double,vec_id:bigint>>")
    # structs of (-score, id) sort the way ranks go
    best = per_block.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list(
        F.transform("near", lambda x: F.struct((-x["score"]).alias("minus"), x["vec_id"].alias("vec_id")))))), 1, k + 1).alias("near"))
    asked = rows.where("q").select(F.col("vec_id").alias("query_id"), "v")
    own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return asked.join(best, "v").select("query_id", F.posexplode(own)).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"), (-F.col("col.minus")).alias("score"))
