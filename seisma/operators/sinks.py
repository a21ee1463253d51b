"""Table sinks: full rebuilds, day-partitioned tables with partition-wise refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seisma.session import scratch_path


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh table location under the shared checkpoint folder (tests / registered queries)."""
    return scratch_path(spark, name)


def write_table(df: DataFrame, path: str, partition_by: str | None = None, cluster_by: str | None = None) -> None:
    """Full rebuild (``materialized='table'``): overwrite the whole location.

    ``cluster_by`` sorts rows within each output partition so Parquet
    row-group min/max statistics skip blocks on that column.  The rebalance
    hint lets AQE split a skewed partition value over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    if cluster_by:
        df = df.sortWithinPartitions(cluster_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_days(df: DataFrame, path: str, date_col: str, cluster_by: str | None = "source",
               overwrite_all: bool = False) -> None:
    """Insert-overwrite by day: replace exactly the ``date_col`` partitions present in ``df``.

    Dynamic partition overwrite: days absent from ``df`` keep their files, so
    an incremental run that recomputes the last N days touches only those.
    ``REBALANCE(day)`` groups a day's rows into few files, and AQE splits a
    skewed day (one day holding a large share of all rows) across several
    tasks instead of one; rows are sorted by ``cluster_by`` within each file.
    """
    out = df.hint("rebalance", date_col)
    if cluster_by and cluster_by in df.columns:
        out = out.sortWithinPartitions(cluster_by)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if overwrite_all else "dynamic")
        .partitionBy(date_col)
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, date_col: str, columns: list[str] | None = None) -> DataFrame:
    """Read a day-partitioned table back with its partition column in place."""
    df = spark.read.parquet(path)
    cols = columns or [c for c in df.columns if c != date_col]
    return df.select(date_col, *[c for c in cols if c != date_col])
