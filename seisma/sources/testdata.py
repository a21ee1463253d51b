"""Bindings from the driver's test tables onto the feed data model.

The driver ships TPC-H-like tables plus an ``events`` table; the three
earthquake feeds, the warehouse job log and the cost baseline are *derived*
from them with DataFrame expressions, so every query's work grows with the
tables.  The matching DuckDB text lives in ``seisma.plans.oracle``.

Feeds from ``events`` (one row per event id, partitioned by id residue):
  usgs      ``id % 5 in (0,1,2)``
  kandilli  ``id % 5 in (2,3)`` -- the ``% 5 = 2`` rows re-report usgs events
            with shifted time, longitude and magnitude
  emsc      ``id % 5 = 4``
``quake_raw`` adds a later version of the rows with ``n % 10 in (0,2,4)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seisma.session import ensure_utc
from seisma.sources.feeds import to_raw
from seisma.sources.schemas import SPECS

# Fixed clock of the driver data (max ts is 2024-01-30 23:59).
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _us(c: Column) -> Column:
    return F.unix_micros(c)


def quake_base(events: DataFrame) -> DataFrame:
    """First version of every feed row, in the normalised event layout (+ ``n``)."""
    n = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    base_mag = F.when(n % 97 == 0, F.lit(None).cast("double")).otherwise(F.round(F.log(F.lit(1) + F.col("value")), 1))
    lon = (F.lit(246) + (F.col("user_id") % 5) * 3).cast("double") / 10
    lat = (F.lit(344) + (F.col("user_id") % 4) * 3).cast("double") / 10
    common = {
        "n": n,
        "updated": ts + F.expr("INTERVAL 5 MINUTES"),
        "ingestion_time": ts + F.expr("INTERVAL 10 MINUTES"),
        "depth_km": (F.lit(5) + n % 30).cast("double"),
        "lat": lat,
        "place": F.col("event_type"),
        "version": F.lit(1),
    }

    def feed(source: str, prefix: str, cond: Column, event_time: Column, mag: Column, lon_: Column) -> DataFrame:
        cols = dict(common)
        cols.update(source=F.lit(source), event_id=F.concat(F.lit(prefix), n.cast("string")),
                    event_time=event_time, mag=mag, lon=lon_)
        order = ["source", "event_id", "n", "event_time", "updated", "ingestion_time", "mag", "depth_km",
                 "lon", "lat", "place", "version"]
        return events.where(cond).select(*[cols[c].alias(c) for c in order])

    k_time = F.timestamp_micros(_us(ts) + (n % 150) * 1_000_000 + 500_000)
    k_mag = F.round(base_mag + (n % 13).cast("double") / 10, 1)
    k_lon = (F.lit(2460) + (F.col("user_id") % 5) * 30 + (n % 41) * 2).cast("double") / 100
    return (
        feed("usgs", "us", (n % 5).isin(0, 1, 2), ts, base_mag, lon)
        .unionByName(feed("kandilli", "kd", (n % 5).isin(2, 3), k_time, k_mag, k_lon))
        .unionByName(feed("emsc", "em", n % 5 == 4, ts, base_mag, lon))
    )


def quake_raw(events: DataFrame) -> DataFrame:
    """``quake_base`` plus a later version of rows with ``n % 10 in (0,2,4)``.

    One scan per feed: the version number is exploded from the row itself.
    """
    base = quake_base(events).drop("version")
    v = F.explode(F.when((F.col("n") % 10).isin(0, 2, 4), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = base.select("*", v.alias("version"))
    later = F.col("version") == 2
    return rows.select(
        "source", "event_id", "n", "event_time",
        F.when(later, F.col("updated") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("updated")).alias("updated"),
        F.when(later, F.col("ingestion_time") + F.expr("INTERVAL 15 MINUTES")).otherwise(F.col("ingestion_time"))
        .alias("ingestion_time"),
        F.when(later, F.round(F.col("mag") + F.lit(0.1), 1)).otherwise(F.col("mag")).alias("mag"),
        "depth_km", "lon", "lat", "place", "version",
    )


def with_feed_columns(q: DataFrame) -> DataFrame:
    """Add the raw-only columns: batch id, the kandilli version name, raw_json."""
    return q.select(
        "*",
        F.col("updated").alias("created_at"),
        F.concat(F.lit("ing-"), F.col("version").cast("string")).alias("ingestion_id"),
        F.concat(F.col("event_id"), F.lit("#"), F.col("version").cast("string")).alias("raw_json"),
    )


def raw_feed(q: DataFrame, source: str) -> DataFrame:
    """Raw table of one feed (its own column layout) from a ``quake_*`` frame."""
    spec = SPECS[source]
    return to_raw(with_feed_columns(q.where(F.col("source") == source)), spec)


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    q = quake_raw(table(spark, sf_dir, "events"))
    return {s: raw_feed(q, s) for s in SPECS}


def job_log(events: DataFrame) -> DataFrame:
    """Warehouse job history derived from ``events`` (one job per event)."""
    n = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    et = F.col("event_type")
    # Query texts: one without back-ticks (-> 'unknown' model), and one per
    # exclusion pattern; statement type cycles over five kinds.
    query = (
        F.when(et == "view", F.concat(F.lit("select * from `proj`.`staging`.`stg_m"), (n % 7).cast("string"),
                                      F.lit("` -- staging.stg")))
        .when(et == "click", F.concat(F.lit("insert into `proj`.`marts`.`dm_m"), (n % 5).cast("string"),
                                      F.lit("` select 1 from marts.x")))
        .when(et == "purchase", F.lit("select count(*) from staging.unnamed"))
        .when(et == "signup", F.concat(F.lit("select * from `p`.`marts`.`x` where 1 in (select 1 from "
                                             "INFORMATION_SCHEMA.JOBS) -- m"), (n % 3).cast("string")))
        .otherwise(F.lit("select * from `p`.`staging_dbt_test__audit`.`t` join staging.y"))
    )
    stmt = F.element_at(F.array(*[F.lit(s) for s in ("SELECT", "INSERT", "CREATE_TABLE_AS_SELECT", "CREATE_VIEW",
                                                       "SCRIPT")]), (F.col("user_id") % 5 + 1).cast("int"))
    return events.select(
        n.cast("string").alias("job_id"),
        F.lit("QUERY").alias("job_type"),
        stmt.alias("statement_type"),
        query.alias("query"),
        F.lit(None).cast("string").alias("destination_table"),
        F.floor(F.col("value") * 1e9).alias("total_bytes_processed"),
        ts.alias("start_time"),
        F.timestamp_micros(_us(ts) + F.floor(F.col("value") * 1_000_000)).alias("end_time"),
        ts.alias("creation_time"),
        F.when(n % 23 == 0, F.lit("boom")).alias("error_result"),
        (n % 2 == 0).alias("cache_hit"),
    )


def cost_baseline(part: DataFrame) -> DataFrame:
    """Baseline bytes per model: one model per part brand."""
    return part.groupBy(F.col("p_brand").alias("model")).agg(
        F.sum(F.col("p_size").cast("bigint") * 1000).alias("bytes_processed")
    ).where(~F.col("model").endswith("5"))


def cost_current(part: DataFrame) -> DataFrame:
    """Current bytes per model: the baseline scaled by part size (some models grow >20 %)."""
    return part.groupBy(F.col("p_brand").alias("model")).agg(
        F.sum(F.col("p_size").cast("bigint") * (F.lit(1000) + (F.col("p_size") % 9) * 40)).alias("bytes_processed")
    )


def merge_inputs(events: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(target, batch) raw frames of one feed for the upsert operators.

    target = first versions of rows with ``n % 6 <> 0`` (version NULL where
    ``n % 11 = 0``); batch = all versions of rows with ``n % 2 = 0`` (version
    NULL where ``n % 7 = 0``), not yet deduplicated.  Every event is in one of them.
    """
    spec = SPECS[source]
    base = with_feed_columns(quake_base(events).where(F.col("source") == source))
    raw = with_feed_columns(quake_raw(events).where(F.col("source") == source))
    n = F.col("n")

    def null_version(df: DataFrame, cond: Column) -> DataFrame:
        return df.withColumn("updated", F.when(cond, F.lit(None)).otherwise(F.col("updated"))).withColumn(
            "created_at", F.col("updated"))

    target = to_raw(null_version(base.where(n % 6 != 0), n % 11 == 0), spec)
    batch = to_raw(null_version(raw.where(n % 2 == 0), n % 7 == 0), spec)
    return target, batch
