"""Readers of the driver tables and small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from seisma.session import checkpoint_dir, scratch_path

#: A side of a join is broadcast only when its measured values fit this many bytes.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, kept in the shared folder, lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _bytes(column: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in a row."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        inner = F.octet_length(column)
    elif isinstance(kind, T.ArrayType):
        fixed = not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType))
        inner = F.size(column) * 8 if fixed else F.aggregate(column, F.lit(0).cast("bigint"), lambda n, x: n + _bytes(x, kind.elementType))
    elif isinstance(kind, T.StructType):
        inner = sum((_bytes(column[f.name], f.dataType) for f in kind.fields), F.lit(0))
    elif isinstance(kind, T.MapType):
        inner = _bytes(F.map_keys(column), T.ArrayType(kind.keyType)) + _bytes(F.map_values(column), T.ArrayType(kind.valueType))
    else:
        inner = F.lit(0)
    return F.coalesce(inner.cast("bigint"), F.lit(0)) + 8


def size_in_bytes(df: DataFrame) -> int:
    row = sum((_bytes(df[f.name], f.dataType) for f in df.schema.fields), F.lit(16))
    return df.agg(F.sum(row)).first()[0] or 0


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast when the measured bytes of its rows allow it, else unchanged (shuffle join)."""
    return F.broadcast(df) if size_in_bytes(df) <= BROADCAST_BYTES else df


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def slices(batch: pa.RecordBatch, text: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of up to ``limit`` bytes of its text column (a longer text is a part of its own)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    ends, lo = np.cumsum(sizes), 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, giving unused memory back when the task ends: worker processes live on into the next stage."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            ctypes.CDLL(None).malloc_trim(0)

    return whole


def filter_batches(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """Rows for which ``keep`` answers true; every column passes through untouched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(keep(b), pa.bool_()))

    return df.mapInArrow(tidy(run), df.schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again (columnar, so later reads prune)."""
    folder = scratch_path(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
