"""Merkle manifest of a dataset, its trees stored in van Emde Boas order.

Rows of one source, ascending by id, are the leaves of a tree of fan-out 16;
the trees' roots, ordered by source, are the leaves of one more tree, whose
root stands for the dataset.  A tree is cut into aligned blocks of ``LEVELS``
hashing levels.  A block keeps its digests in one array in van Emde Boas order:
a tree of h node levels stores its upper h // 2 levels first and the subtrees
that hang below one after the other, each laid out the same way.  Addresses are
computed, never stored.  Block roots are the leaves of the next layer of
blocks, and so on until a source has a single root.

In Spark: leaf digests come from column expressions; one range shuffle of
narrow rows gives every leaf its place; blocks are made by tasks that hold one
block at a time, and each layer is a written table (the manifest).  Proofs go
the other way: a layer hands every block below it the siblings on its path, so
a task needs one block and the path above it.

Defined results: a null field hashes as ``-``; a null source is a source of its
own and comes first; rows with equal ids follow each other by their digests,
null ids first; repeated rows are leaves of their own; an empty table has no
rows and no root; columns that are not hashed are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from seisma.llm.tables import written

FANOUT = 16
#: Hashing levels of a block: 256 leaves, 273 digests.
LEVELS = 2
FULL = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 32


def digest(data: bytes) -> bytes:
    """Lowercase hex SHA-256: digests are hashed again as hex text."""
    return hashlib.sha256(data).hexdigest().encode()


# van Emde Boas addresses


def _size(levels: int) -> int:
    return (FANOUT**levels - 1) // (FANOUT - 1)


@lru_cache(maxsize=None)
def addresses(levels: int, depth: int) -> np.ndarray:
    """Places of all nodes at ``depth`` (root 0) of a complete tree of ``levels`` node levels."""
    if levels == 1:
        return np.zeros(1, dtype=np.int64)
    top = levels // 2
    if depth < top:
        return addresses(top, depth)
    below = levels - top
    inside = addresses(below, depth - top)
    trees = np.arange(FANOUT**top, dtype=np.int64)
    return (_size(top) + trees[:, None] * _size(below) + inside[None, :]).ravel()


def steps(total: int) -> int:
    """Hashing levels of a block in a layer of ``total`` nodes: all that are left, ``LEVELS`` at most."""
    n = 0
    while total > 1 and n < LEVELS:
        total, n = -(-total // FANOUT), n + 1
    return n


def build_block(leaves: list[bytes], levels: int) -> tuple[np.ndarray, bytes]:
    """The block's digests in van Emde Boas order (absent nodes are zero), and its root in hex."""
    store = np.zeros((_size(levels + 1), _DIGEST), dtype=np.uint8)
    row = leaves
    for depth in range(levels, -1, -1):
        store[addresses(levels + 1, depth)[: len(row)]] = np.frombuffer(bytes.fromhex(b"".join(row).decode()), np.uint8).reshape(-1, _DIGEST)
        if depth:
            row = [digest(b"".join(row[i : i + FANOUT])) for i in range(0, len(row), FANOUT)]
    return store, row[0]


def read_block(store: bytes, n: int, levels: int) -> list[list[bytes]]:
    """Digests in hex by depth, the root first, read off the stored array."""
    nodes, widths = np.frombuffer(store, np.uint8).reshape(-1, _DIGEST), [n]
    for _ in range(levels):
        widths.append(-(-widths[-1] // FANOUT))
    out = []
    for depth, width in enumerate(reversed(widths)):
        raw = nodes[addresses(levels + 1, depth)[:width]].tobytes().hex().encode()
        out.append([raw[i : i + 2 * _DIGEST] for i in range(0, len(raw), 2 * _DIGEST)])
    return out


# a path is, for each level upwards: one byte index in the run, one byte number of siblings, their digests in hex


def _step(run: list[bytes], i: int) -> bytes:
    return bytes((i, len(run) - 1)) + b"".join(run[:i]) + b"".join(run[i + 1 :])


def _above(rows: list[list[bytes]], upper: bytes) -> list[bytes]:
    """For every run of leaves of a block: the path from the run's parent to the top."""
    paths = [upper]
    for row in rows[1:-1]:
        paths = [_step(row[i - i % FANOUT : i - i % FANOUT + FANOUT], i % FANOUT) + paths[i // FANOUT] for i in range(len(row))]
    return paths


def paths_of(rows: list[list[bytes]], upper: bytes) -> list[bytes]:
    """The whole path of every leaf of a block."""
    leaves, above = rows[-1], _above(rows, upper)
    if len(rows) == 1:
        return [upper]
    return [_step(leaves[i - i % FANOUT : i - i % FANOUT + FANOUT], i % FANOUT) + above[i // FANOUT] for i in range(len(leaves))]


def path_levels(path: bytes) -> Iterator[tuple[int, bytes]]:
    """(index in the run, siblings in hex one after the other) level by level."""
    at = 0
    while at < len(path):
        i, n = path[at], path[at + 1]
        yield i, path[at + 2 : at + 2 + n * 2 * _DIGEST]
        at += 2 + n * 2 * _DIGEST


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that follows from a leaf and its path."""
    for i, siblings in path_levels(path):
        cut = i * 2 * _DIGEST
        leaf = digest(siblings[:cut] + leaf + siblings[cut:])
    return leaf


def proof_digest(path: bytes) -> bytes:
    return digest(b"".join(s for _, s in path_levels(path)))


# Spark


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` or its UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, doc_id: str = "doc_id", source: str = "source",
           now: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """source, doc_id, leaf; ``probe`` is the digest of the row as it is found now, where ``when`` holds (else null).

    ``now`` names the columns that are found changed.
    """
    of = {f: F.col(f) for f in fields}
    probe = F.lit(None).cast("string")
    if now:
        probe = F.when(F.coalesce(when, F.lit(False)) if when is not None else F.lit(True), leaf_digest(list({**of, **now}.values())))
    return docs.select(F.col(source).cast("string").alias("source"), F.col(doc_id).alias("doc_id"),
                       F.unhex(leaf_digest(list(of.values()))).alias("leaf"), F.unhex(probe).alias("probe"))


def placed(rows: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0 within the key, by ``order``) and ``total`` (rows of the key).

    One range shuffle by key and order, so that a key with a third of all rows is spread over many
    tasks; the joined table has a row for each key and partition.
    """
    rows = written(rows, f"{name}-rows")  # the bounds are sampled from this narrow table
    by = [F.col(c).asc_nulls_first() for c in (key, *order)]
    rows = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), f"{name}-sorted")
    part = F.shiftright("_at", 33)  # the id is partition << 33 | row
    runs = rows.groupBy(F.col(key).alias("_k"), part.alias("_p")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_k")
    runs = runs.select("_k", "_p", (F.sum("_n").over(w.orderBy("_p")) - F.col("_n") - F.col("_first")).alias("_shift"), F.sum("_n").over(w).alias("total"))
    return rows.join(runs, part.eqNullSafe(F.col("_p")) & F.col(key).eqNullSafe(F.col("_k"))).select(
        *[c for c in rows.columns if c != "_at"], (F.col("_at") + F.col("_shift")).alias("pos"), "total")


_BLOCK = "source string, block bigint, total bigint, n int, root binary, store binary"


def _layer(nodes: DataFrame, carried: Sequence[str], name: str) -> DataFrame:
    """Blocks of a layer of nodes (source, pos, total, leaf); ``carried`` columns become lists in the order of the leaves."""
    extra = "".join(f", {c} array<{nodes.schema[c].dataType.simpleString()}>" for c in carried)
    dealt = nodes.withColumn("block", F.expr(f"pos div {FULL}")).select("source", "block", "total", "leaf", "pos", *carried)
    dealt = dealt.repartition("source", "block").sortWithinPartitions(F.col("source").asc_nulls_first(), "block", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        held: list[pa.RecordBatch] = []
        for b in batches:
            schema = schema or b.schema
            ends = _run_ends(b.column(0), b.column(1))
            start = 0
            for end in ends:
                if held and not _same(held[-1], held[-1].num_rows - 1, b, start):
                    yield _block(held, carried)
                    held = []
                held.append(b.slice(start, end - start))
                start = end
        if held:
            yield _block(held, carried)

    return written(dealt.mapInArrow(run, _BLOCK + extra), name)


def _run_ends(*columns: pa.Array) -> list[int]:
    """Where runs of equal rows end."""
    rows = list(zip(*(c.to_pylist() for c in columns)))
    return [i + 1 for i in range(len(rows)) if i + 1 == len(rows) or rows[i + 1] != rows[i]]


def _same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int) -> bool:
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in (0, 1))


def _block(parts: list[pa.RecordBatch], carried: Sequence[str]) -> pa.RecordBatch:
    t = pa.Table.from_batches(parts).combine_chunks()
    n, total = t.num_rows, t.column("total")[0].as_py()
    store, root = build_block([x.hex().encode() for x in t.column("leaf").to_pylist()], steps(total))
    lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), t.column(c).chunk(0)) for c in carried]
    return pa.RecordBatch.from_arrays([
        pa.array([t.column("source")[0].as_py()], pa.string()), pa.array([t.column("block")[0].as_py()], pa.int64()), pa.array([total], pa.int64()),
        pa.array([n], pa.int32()), pa.array([bytes.fromhex(root.decode())], pa.binary()), pa.array([store.tobytes()], pa.binary()), *lists,
    ], names=["source", "block", "total", "n", "root", "store", *carried])


def _tree(nodes: DataFrame, carried: Sequence[str], name: str) -> list[DataFrame]:
    """All layers of the trees over ``nodes``, the leaves' layer first."""
    layers = [_layer(nodes, carried, f"{name}-0")]
    while layers[-1].where(F.col("total") > FULL).limit(1).count():
        up = layers[-1].where(F.col("total") > FULL).select(
            "source", F.col("block").alias("pos"), F.ceil(F.col("total") / FULL).cast("bigint").alias("total"), F.col("root").alias("leaf"))
        layers.append(_layer(up, (), f"{name}-{len(layers)}"))
    return layers


@dataclass
class Manifest:
    """Layers of blocks of the sources' trees and of the tree over their roots, and the place of each source in it."""

    trees: list[DataFrame]
    top: list[DataFrame]
    sources: DataFrame


def build(rows: DataFrame) -> Manifest:
    """The manifest of rows of ``leaves``, as tables in the shared folder."""
    trees = _tree(placed(rows, "source", ("doc_id", "leaf"), "merkle"), ("doc_id", "probe"), "merkle-tree")
    subroots = trees[0].where(F.col("total") <= FULL).select("source", "root")
    for t in trees[1:]:
        subroots = subroots.unionByName(t.where(F.col("total") <= FULL).select("source", "root"))
    sources = written(placed(subroots.withColumn("_all", F.lit(0)), "_all", ("source",), "merkle-top").select(
        "source", "pos", "total", F.col("root").alias("leaf")), "merkle-sources")
    top = _tree(sources.select(F.lit(None).cast("string").alias("source"), "pos", "total", "leaf"), (), "merkle-top")
    return Manifest(trees, top, sources)


def _down(blocks: DataFrame, uppers: DataFrame) -> DataFrame:
    """(source, block, path, subroot, root) of the blocks below: each leaf of ``blocks`` gets its path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                got = paths_of(read_block(r["store"], r["n"], steps(r["total"])), r["path"])
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["source"]] * len(got), pa.string()), pa.array(np.arange(len(got)) + r["block"] * FULL),
                    pa.array(got, pa.binary()), pa.array([r["subroot"]] * len(got), pa.string()), pa.array([r["top"]] * len(got), pa.string())],
                    names=["source", "block", "path", "subroot", "top"])

    return _met(blocks, uppers).mapInArrow(run, "source string, block bigint, path binary, subroot string, top string")


def _met(blocks: DataFrame, uppers: DataFrame) -> DataFrame:
    u = uppers.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "path", "subroot", "top")
    return blocks.join(u, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b"))).drop("_s", "_b")


def _uppers(m: Manifest) -> DataFrame:
    """Path, subroot and root above every block of the sources' lowest layer."""
    last = m.top[-1]
    ups = last.select("source", "block", F.lit(b"").alias("path"), F.lit("").alias("subroot"), F.lower(F.hex("root")).alias("top"))
    for layer in reversed(m.top):
        ups = written(_down(layer, ups), "merkle-path")
    by_source = m.sources.join(ups.select(F.col("block").alias("pos"), "path", "top"), "pos").select(
        F.col("source"), F.lit(0).cast("bigint").alias("block"), "path", F.lower(F.hex("leaf")).alias("subroot"), "top")
    ups = None
    for k in reversed(range(len(m.trees))):
        ends = m.trees[k].where(F.col("total") <= FULL).select(F.col("source").alias("_e"))  # sources whose tree ends in this layer
        own = by_source.join(ends, F.col("source").eqNullSafe(F.col("_e"))).drop("_e")
        ups = written(own if ups is None else own.unionByName(_down(m.trees[k + 1], ups)), "merkle-path")
    return ups


def prove(m: Manifest, result: Callable[[bytes, bytes | None, bytes, str, str], tuple], fields: str, kinds: list[pa.DataType]) -> DataFrame:
    """doc_id and ``result(leaf, probe, path, subroot, root)`` of every leaf."""
    kind = m.trees[0].schema["doc_id"].dataType.elementType.simpleString()
    names = ["doc_id", *(f.split()[0] for f in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in ("store", "n", "total", "probe", "path", "subroot", "top")}
                rows = read_block(r["store"], r["n"], steps(r["total"]))
                got = [result(leaf, None if p is None else p.hex().encode(), path, r["subroot"], r["top"])
                       for leaf, p, path in zip(rows[-1], r["probe"], paths_of(rows, r["path"]))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[i].values, *(pa.array([g[k] for g in got], t) for k, t in enumerate(kinds))], names=names)

    return _met(m.trees[0], _uppers(m)).mapInArrow(run, f"doc_id {kind}, {fields}")


def verify(m: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (of the probe, where there is one) and verified."""

    def result(leaf: bytes, probe: bytes | None, path: bytes, subroot: str, root: str) -> tuple:
        folded = fold(probe or leaf, path).decode()
        return leaf.decode(), subroot, root, proof_digest(path).decode(), folded, folded == root

    return prove(m, result, "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
                 [pa.string()] * 5 + [pa.bool_()])
