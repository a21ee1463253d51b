"""Keep the latest version of each record (ROW_NUMBER() ... = 1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first row under ``order_by``.

    Written as ``row_number() = 1`` so Catalyst plans a *partial*
    ``WindowGroupLimit`` before the shuffle and a final one after it: each map
    task forwards at most one row per key, so a hot key (many versions of one
    record) costs one row per task in the exchange, not all its versions.
    ``order_by`` should end in a unique column to make the pick deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def feed_order(version: str) -> list[Column]:
    """Latest ingestion first, then newest source version (NULL versions last)."""
    return [
        F.col("ingestion_time").desc_nulls_last(),
        F.col(version).desc_nulls_last(),
        F.col("ingestion_id").desc_nulls_last(),
        F.col("raw_json").asc_nulls_last(),
    ]
