"""Staging normal form: dedup a raw feed table and project it to the common columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seisma.operators.dedup import dedup_latest, feed_order
from seisma.sources.schemas import SourceSpec


def stg_project(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rename raw columns to the staging columns (no dedup): common 11 + feed extras."""
    cols = []
    for out, src in spec.stg_columns():
        if out == "source":
            cols.append(F.lit(spec.name).alias("source"))
        else:
            cols.append(F.col(src).alias(out))
    return raw.select(*cols)


def stg(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Latest row per key (by ingestion time, then version), projected to staging form."""
    latest = dedup_latest(raw, [spec.key], feed_order(spec.version))
    return stg_project(latest, spec)
