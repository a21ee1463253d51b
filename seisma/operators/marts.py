"""Marts and report aggregates over the staging / unified tables.

Every aggregate is a ``groupBy().agg`` (partial + final hash aggregation, so a
hot group is combined map-side before the shuffle).  Means that get rounded
are taken as an exact decimal sum over a count, so the rounded value does not
depend on the summation order of floating-point partials; values too large for
that and NaN are added as doubles (several such values in any order).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Finite values up to this size are summed as decimals; beyond it, and for NaN and infinities, as doubles.
DECIMAL_LIMIT = 1e15


def _decimal_part(col: Column, scale: int) -> Column:
    """Sum of the values that a decimal holds; NULL when there are none."""
    return F.sum(F.when(F.abs(col.cast("double")) < DECIMAL_LIMIT, col.cast("double").cast(f"decimal(38,{scale})")))


def _double_part(col: Column) -> Column:
    """Sum of the others, NaN (greater than all numbers) and infinities included; NULL when there are none."""
    return F.sum(F.when(F.abs(col.cast("double")) >= DECIMAL_LIMIT, col.cast("double")))


def _whole(decimals: Column, doubles: Column) -> Column:
    return F.when(doubles.isNull(), decimals.cast("double")).otherwise(F.coalesce(decimals.cast("double"), F.lit(0.0)) + doubles)


def exact_sum(c: str | Column, scale: int = 10) -> Column:
    """SUM whose decimal part does not depend on the order of rows; a NaN gives NaN, values of any size are taken."""
    col = F.col(c) if isinstance(c, str) else c
    return _whole(_decimal_part(col, scale), _double_part(col))


def exact_mean(c: str | Column, scale: int = 12) -> Column:
    """AVG as ``exact_sum`` over the count, NULLs excluded (12 decimals hold a magnitude's digits)."""
    return exact_sum(c, scale) / F.count(F.col(c) if isinstance(c, str) else c)


def source_rows(stg_tables: Mapping[str, DataFrame], since: dt.date | None = None) -> DataFrame:
    """UNION ALL of ``(event_date, source, magnitude, event_id)`` over the feeds."""
    out = None
    for name, df in stg_tables.items():
        partitioned = "event_date" in df.columns  # day-partitioned table: prune by directory
        if since is not None:
            # to_date(event_time) >= since  <=>  event_time >= since 00:00 UTC,
            # written on the raw column so it reaches the Parquet reader.
            df = df.where(F.col("event_time") >= F.lit(dt.datetime.combine(since, dt.time())).cast("timestamp"))
            if partitioned:
                df = df.where(F.col("event_date") >= F.lit(since))
        part = df.select(
            (F.col("event_date") if partitioned else F.to_date("event_time")).alias("event_date"),
            F.lit(name).alias("source"),
            F.col("mag").alias("magnitude"),
            F.col("earthquake_id").alias("event_id"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def daily_stats(stg_tables: Mapping[str, DataFrame], processed_at: dt.datetime,
                since: dt.date | None = None) -> DataFrame:
    """Per (event_date, source): distinct events and rounded mean/max/min magnitude.

    NULL magnitudes are dropped first, so they are not counted either.  With
    ``since`` only days on or after it are produced (incremental refresh; the
    same cut for every source).
    """
    rows = source_rows(stg_tables, since).where(F.col("magnitude").isNotNull())
    # COUNT(DISTINCT) as two exact aggregation levels instead of Spark's
    # Expand (which doubles every row before the first shuffle): per event
    # first -- this shuffle is keyed by event id, so a hot day is spread --
    # then per (day, source) over one pre-aggregated row per event.
    m = F.col("magnitude")
    per_event = rows.groupBy("event_date", "source", "event_id").agg(
        _decimal_part(m, 12).alias("_s"), _double_part(m).alias("_d"), F.count(m).alias("_c"),
        F.max(m).alias("_max"), F.min(m).alias("_min"),
    )
    return per_event.groupBy("event_date", "source").agg(
        F.count(F.lit(1)).alias("earthquake_count"),
        F.round(_whole(F.sum("_s"), F.sum("_d")) / F.sum("_c"), 2).alias("avg_magnitude"),
        F.round(F.max("_max"), 2).alias("max_magnitude"),
        F.round(F.min("_min"), 2).alias("min_magnitude"),
        F.lit(processed_at).cast("timestamp").alias("processed_at"),
    )


def hourly_counts(df: DataFrame, ts: str, since: dt.datetime | None = None) -> DataFrame:
    """``COUNT(*) GROUP BY TIMESTAMP_TRUNC(ts, HOUR)``."""
    if since is not None:
        df = df.where(F.col(ts) >= F.lit(since).cast("timestamp"))
    return df.groupBy(F.date_trunc("HOUR", F.col(ts)).alias("hour_bucket")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


def source_stats(raws: Sequence[tuple[str, DataFrame, str]], as_of: dt.datetime,
                 window: dt.timedelta = dt.timedelta(hours=24)) -> DataFrame:
    """One row per feed: events in the last ``window`` and their rounded mean magnitude.

    ``raws`` = (label, raw table, time column).  The one-row aggregates are
    stacked positionally (UNION ALL), names from the first branch.
    """
    out = None
    for label, df, ts in raws:
        part = df.where(F.col(ts) >= F.lit(as_of - window).cast("timestamp")).agg(
            F.lit(label).alias("source"),
            F.count(F.lit(1)).alias("event_count"),
            F.round(exact_mean("mag"), 2).alias("avg_mag"),
        )
        out = part if out is None else out.union(part)
    return out


def recent_daily_top(daily: DataFrame, n: int = 10) -> DataFrame:
    """``WHERE earthquake_count > 0 ORDER BY event_date DESC, source LIMIT n`` (a top-k report)."""
    return (
        daily.where(F.col("earthquake_count") > 0)
        .select("event_date", "source", "earthquake_count", "avg_magnitude", "max_magnitude")
        .orderBy(F.col("event_date").desc(), F.col("source").asc())
        .limit(n)
    )


def max_event_time(df: DataFrame, ts: str, as_of: dt.datetime, search: dt.timedelta) -> DataFrame:
    """Global MAX over a recent window; one row even when the window is empty."""
    return df.where(F.col(ts) >= F.lit(as_of - search).cast("timestamp")).agg(
        F.max(ts).alias("latest_event_time")
    )


def top_n(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    """Global top-``n`` rows with their 1-based position ``pos``.

    ``row_number() <= n`` over an unpartitioned window: Catalyst pushes the
    limit below the window (``TakeOrderedAndProject``: a top-``n`` per task,
    then a merge of those), so the single final partition only sees ``n``
    rows per upstream task, never the whole input.
    """
    w = Window.orderBy(*order_by)
    return df.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n)


def count_with_top(df: DataFrame, order_by: Sequence[Column], n: int, fields: Sequence[str],
                   count_name: str = "n_rows") -> DataFrame:
    """Total row count attached to each of the top-``n`` rows; no rows when the input is empty.

    The count is a one-row aggregate and the top rows are at most ``n``; they
    are combined by a union and a window over those <= n+1 rows, not a join.
    """
    rows = df.select(*fields)
    top = top_n(rows, order_by, n).select(
        F.lit(None).cast("bigint").alias(count_name), "pos", *fields)
    # count(struct(fields)) counts every row (the struct is never NULL) and makes
    # this branch read the same columns as the top-n branch, so the two share
    # the exchanges of ``df``'s plan instead of computing it twice.
    cnt = rows.agg(F.count(F.struct(*fields)).alias(count_name)).select(
        count_name, F.lit(0).alias("pos"), *[F.lit(None).cast(df.schema[f].dataType).alias(f) for f in fields])
    both = top.unionByName(cnt)
    total = F.max(count_name).over(Window.partitionBy(F.lit(1)))
    return both.withColumn(count_name, total).where((F.col("pos") > 0) & (F.col(count_name) > 0)).withColumn(
        "pos", F.col("pos").cast("bigint"))


def top_n_structs(df: DataFrame, fields: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    """``ARRAY_AGG(STRUCT(fields) ORDER BY ... LIMIT n)`` as one row with an array column."""
    top = top_n(df, order_by, n)
    return top.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("pos"), F.struct(*fields).alias("v")))),
            lambda x: x.getField("v"),
        ).alias("top")
    )
