"""Candidate pairs in packed form: the events of a block once a side, not a row for each pair.

Where events are dense the pairs grow as the square of the events, and a row a pair is dear to
join, keep and read again.  A packed row holds some events of either side that share a blocking key
(``seisma.operators.matching``); its pairs are all that lie within the thresholds, so nothing is
left out.  ``unpacked`` gives them as rows, or only those that the mutual-best choice can need:
pairs are first tested in arrays, a bounded number at a time, and those left by the matcher's own
expressions.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from seisma.functions.geo import EARTH_RADIUS_KM
from seisma.operators.matching import DEFAULT, MatchConfig, pair_columns, within

#: Events of one side in a packed row, at most.
PACK_ROWS = 1024

#: Rows that a task gathers before it packs them.
_GATHERED = 1 << 18

#: Events whose packed rows a task takes up at once, and pairs that it tests at once.
_TAKEN = 1 << 16
_TESTED = 1 << 17

_FIELDS = ("id", "time", "mag", "lon", "lat", "place")


def packed(df: DataFrame, by: list[str], p: str) -> DataFrame:
    """Events of one side (matcher columns prefixed ``p``) packed by the columns ``by``.

    A row holds at most ``PACK_ROWS`` events, as arrays (times as micros), and ``<p>_pack``: sixteen
    random bytes, so that an event's place in a pack names its arrival.  Each event stands in one row.
    """
    names, size, gathered = [f"{p}_{f}" for f in _FIELDS], PACK_ROWS, _GATHERED
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*by, *[F.unix_micros(c).alias(c) if c == f"{p}_time" else F.col(c) for c in names]).repartition(n, *by)
    schema = StructType([*[rows.schema[c] for c in by], StructField(f"{p}_pack", BinaryType()),
                         *[StructField(c, ArrayType(rows.schema[c].dataType)) for c in names]])

    # all nested: workers get these functions by value and need no copy of this package
    def number(column: pa.ChunkedArray) -> np.ndarray:
        column = column.cast(pa.int32()) if pa.types.is_date32(column.type) else column
        return column.cast(pa.int64()).to_numpy()

    def packs(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        keys = [number(rows.column(c)) for c in by]
        order = np.lexsort(keys[::-1])
        starts = np.ones(len(order), dtype=bool)
        starts[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
        group = np.flatnonzero(starts)
        place = np.arange(len(order)) - np.repeat(group, np.diff(group, append=len(order)))
        first = np.flatnonzero(place % size == 0)
        heads = rows.select(by).take(pa.array(order[first]))
        rows = rows.select(names).take(pa.array(order)).combine_chunks()
        marks = pa.array([os.urandom(16) for _ in first], pa.binary())
        ends = pa.array(np.append(first, len(order)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, c.chunk(0) if isinstance(c, pa.ChunkedArray) else c) for c in rows.columns]
        out = pa.Table.from_arrays([*heads.columns, marks, *lists], names=[*by, f"{p}_pack", *names])
        yield from out.to_batches(max_chunksize=1000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= gathered:
                yield from packs(held)
                held, n = [], 0
        if n:
            yield from packs(held)

    return rows.mapInArrow(run, schema)


def unpacked(packs: DataFrame, cfg: MatchConfig = DEFAULT, nearest: bool = False, start: str = "_lstart", keep: tuple[str, ...] = ()) -> DataFrame:
    """The pairs of packed rows, a row each, with the columns ``keep`` of the packed row.

    With ``nearest`` a pair stays out where both its events have a nearer one in the same packed row
    (distance, then time, then id): ``mutual_best`` gives the same of those left.  A pair of which the
    arrays cannot tell whether it is nearer, as distances differ in the last digits between libraries,
    stays; so the result rests on the matcher's own expressions.

    ``start`` is the start of a row's time bucket, which the rows of both sides are ordered from.
    Rows are dealt by an explicit number of partitions: they are dear by their pairs, not their bytes.
    """
    l, r = cfg.left, cfg.right
    left, right = ([f"{p}_{f}" for f in _FIELDS] for p in (l, r))
    n = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = packs.select(*keep, F.unix_micros(start).alias("_at"), f"{l}_pack", f"{r}_pack", *left, *right).repartition(n, f"{l}_pack", f"{r}_pack")
    schema = StructType([*[packs.schema[c] for c in keep], *[StructField(c, packs.schema[c].dataType.elementType) for c in left + right]])

    tested, taken = _TESTED, _TAKEN
    reach, max_mag, max_km, lat_reach = cfg.reach_micros, cfg.max_mag_diff, cfg.max_km, cfg.lat_reach_deg
    spare = 1 << 20  # micros that a bucket's edge may be off by
    span = cfg.time_bucket_seconds * 1_000_000 + 2 * (reach + spare) + 1
    scale, radius = 10.0 ** cfg.rank_digits, EARTH_RADIUS_KM

    # all nested: workers get these functions by value and need no copy of this package
    def side(b: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, np.ndarray, dict[str, pa.Array]]:
        """The packed row of each event, its time from the first that can stand in its row, and the columns."""
        lengths = pc.list_value_length(b.column(names[0])).to_numpy()
        row = np.repeat(np.arange(b.num_rows), lengths)
        columns = {f: b.column(c).flatten() for f, c in zip(("id", "time", "mag", "lon", "lat", "place"), names)}
        at = b.column("_at").to_numpy()
        return row, columns["time"].to_numpy() - at[row] + reach + spare, columns

    def numbers(columns: dict[str, pa.Array]) -> list[np.ndarray]:
        mag = pc.fill_null(columns["mag"], 0.0)
        return [c.to_numpy(zero_copy_only=False) for c in (mag, columns["lat"], columns["lon"])]

    def places(ids: pa.Array) -> np.ndarray:
        """The place of each id in the order of UTF-8 bytes, equal ids at one."""
        codes = ids.dictionary_encode()
        place = np.empty(len(codes.dictionary) + 1, dtype=np.int64)
        place[pc.sort_indices(codes.dictionary.cast(pa.binary())).to_numpy()] = np.arange(1, len(place))
        place[-1] = 0  # NULL is the least
        return place[pc.fill_null(codes.indices, len(place) - 1).to_numpy()]

    def least(code: np.ndarray, low: np.ndarray, high: np.ndarray, then: np.ndarray) -> np.ndarray:
        """Which pairs can be the least of their event, whose rank lies between ``low`` and ``high``."""
        code = code - code.min()
        best = np.full(int(code.max()) + 1, np.inf)
        np.minimum.at(best, code, high)
        mine = best[code]
        keep = low < mine
        even = np.flatnonzero(low == mine)
        sure = even[high[even] == mine[even]]
        first = np.full(len(best), np.iinfo(np.int64).max)
        np.minimum.at(first, code[sure], then[sure])
        keep[even] |= then[even] <= first[code[even]]
        return keep

    def pairs(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the left and right events of pairs that may lie within the thresholds."""
        lrow, lrel, lcols = side(b, left)
        rrow, rrel, rcols = side(b, right)
        order = np.lexsort((rrel, rrow))
        line, rtime = rrow[order] * span + rrel[order], rcols["time"].to_numpy()[order]
        ends = np.append(0, np.cumsum(np.bincount(rrow, minlength=b.num_rows)))
        low = np.maximum(np.searchsorted(line, lrow * span + (lrel - reach), "left"), ends[lrow])
        high = np.minimum(np.searchsorted(line, lrow * span + (lrel + reach), "right"), ends[lrow + 1])
        count = np.maximum(high - low, 0)
        some = np.flatnonzero(count)
        if not len(some):
            return
        low, count, total = low[some], count[some], np.cumsum(count[some])
        ltime, (lmag, llat, llon) = lcols["time"].to_numpy(), numbers(lcols)
        rmag, rlat, rlon = (x[order] for x in numbers(rcols))
        lcos, rcos = np.cos(llat * (np.pi / 180)), np.cos(rlat * (np.pi / 180))
        if nearest:
            lplace, rplace = places(lcols["id"]), places(rcols["id"])[order]
            bits = int(max(lplace.max(), rplace.max())).bit_length()
        found, at = [], 0
        while at < len(some):
            done = total[at - 1] if at else 0
            until = max(at + 1, int(np.searchsorted(total, done + tested, "right")))
            c = count[at:until]
            i = np.repeat(some[at:until], c)
            j = np.arange(len(i)) + np.repeat(low[at:until] - (total[at:until] - c - done), c)
            at = until
            near = np.flatnonzero((np.abs(lmag[i] - rmag[j]) <= max_mag) & (np.abs(llat[i] - rlat[j]) <= lat_reach))
            i, j = i[near], j[near]
            half = np.pi / 360
            a = np.sin((rlat[j] - llat[i]) * half) ** 2 + lcos[i] * rcos[j] * np.sin((rlon[j] - llon[i]) * half) ** 2
            x = np.sqrt(np.fmin(a, 1.0))
            far = 2 * radius * np.arcsin(x)
            off = 2e-14 * radius * x / np.sqrt(np.maximum(1 - x * x, 1e-14))  # more than two libraries can differ by
            near = np.flatnonzero(far - off <= max_km)
            i, j = i[near], j[near]
            if not len(i):
                continue
            if not nearest:
                yield i, order[j]
                continue
            far, off = far[near], off[near]
            first = np.floor((far - off) * scale + 0.5)
            last = np.where(far + off <= max_km, np.floor((far + off) * scale + 0.5), np.inf)
            later = (np.abs(ltime[i] - rtime[j]) // 1_000_000) << bits
            after = later | rplace[j], later | lplace[i]
            keep = np.flatnonzero(least(i, first, last, after[0]) | least(j, first, last, after[1]))
            found.append([x[keep] for x in (i, j, first, last, *after)])
        if found:
            i, j, first, last, l_after, r_after = (np.concatenate(x) for x in zip(*found))
            keep = least(i, first, last, l_after) | least(j, first, last, r_after)
            yield i[keep], order[j[keep]]

    def some_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            events, at = np.cumsum(sum(pc.list_value_length(b.column(c[0])).to_numpy() for c in (left, right))), 0
            while at < b.num_rows:
                until = max(at + 1, int(np.searchsorted(events, (events[at - 1] if at else 0) + taken, "right")))
                yield b.slice(at, until - at)
                at = until

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in some_rows(batches):
            lists = {c: b.column(c).flatten() for c in left + right}
            row = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column(left[0])).to_numpy())
            for i, j in pairs(b):
                li, rj, of = pa.array(i), pa.array(j), pa.array(row[i])
                columns = [*[b.column(c).take(of) for c in keep], *[lists[c].take(li) for c in left], *[lists[c].take(rj) for c in right]]
                yield from pa.Table.from_arrays(columns, names=[*keep, *left, *right]).to_batches(max_chunksize=10_000)

    rows = packs.mapInArrow(run, schema).withColumns({c: F.timestamp_micros(c) for c in (f"{l}_time", f"{r}_time")})
    return rows.where(within(cfg)).select(*pair_columns(cfg), *keep)
