"""Render feed rows as the three feeds' JSON documents (inverse of the parsers).

Used to produce feed documents *from the driver tables*, so the parsers run
over data whose size grows with the tables.  Rows are grouped into documents
by ``floor(n / block)`` of the numeric event id: a document holds at most
``2 * block`` features whatever the table size (ids are unique per feed and
each id has at most two versions), so no group is unbounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 500


def _docs(rows: DataFrame, item: F.Column, envelope, block: int) -> DataFrame:
    g = rows.groupBy((F.col("n") / block).cast("bigint").alias("doc_no")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("n"), F.col("version"), item.alias("it")))).alias("items"))
    items = F.transform(F.col("items"), lambda x: x.getField("it"))
    return g.select("doc_no", F.to_json(envelope(items, F.col("doc_no"))).alias("doc"))


def usgs_documents(q: DataFrame, block: int = BLOCK) -> DataFrame:
    """GeoJSON FeatureCollections (coordinates in geometry, times as epoch ms)."""
    q = q.where(F.col("source") == "usgs")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.col("event_id").alias("id"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col("lon"), F.col("lat"), F.col("depth_km")).alias("coordinates")).alias("geometry"),
        F.struct(
            F.col("mag").alias("mag"), F.col("place").alias("place"),
            F.unix_millis(F.col("event_time")).alias("time"), F.unix_millis(F.col("updated")).alias("updated"),
            F.lit("ml").alias("magType"), F.lit("earthquake").alias("type"), F.lit("reviewed").alias("status"),
        ).alias("properties"),
    )
    return _docs(q, feature, lambda items, no: F.struct(F.lit("FeatureCollection").alias("type"),
                                                         items.alias("features")), block)


def emsc_documents(q: DataFrame, block: int = BLOCK) -> DataFrame:
    """Properties-only features: ISO time text, epoch-ms ``lastupdate``, id in source_id or unid."""
    q = q.where(F.col("source") == "emsc")
    even = F.col("n") % 2 == 0
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.when(even, F.col("event_id")).otherwise(F.lit("")).alias("source_id"),
            F.when(~even, F.col("event_id")).alias("unid"),
            F.col("mag").alias("mag"), F.lit("mb").alias("magtype"),
            F.date_format(F.col("event_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
            F.unix_millis(F.col("updated")).cast("string").alias("lastupdate"),
            F.col("lat").alias("lat"), F.col("lon").alias("lon"), F.col("depth_km").alias("depth"),
            F.col("place").alias("flynn_region"), F.lit("ke").alias("evtype"),
        ).alias("properties"),
    )
    return _docs(q, feature, lambda items, no: F.struct(F.lit("FeatureCollection").alias("type"),
                                                         items.alias("features")), block)


def kandilli_documents(q: DataFrame, block: int = BLOCK, zone: str = "Europe/Istanbul",
                       corrupt_every: int | None = None) -> DataFrame:
    """``{status, result[]}`` envelopes (``results`` on odd documents), local wall-clock times.

    With ``corrupt_every = k`` the items with ``n % k = 0`` carry a time text
    that does not parse (for quarantine tests).
    """
    q = q.where(F.col("source") == "kandilli")
    local = F.from_utc_timestamp(F.col("event_time"), zone)
    text = F.date_format(local, "yyyy.MM.dd HH:mm:ss")
    if corrupt_every:
        text = F.when(F.col("n") % corrupt_every == 0, F.concat(F.lit("??"), text)).otherwise(text)
    item = F.struct(
        F.col("event_id").alias("earthquake_id"),
        text.alias("date_time"),
        F.concat(F.date_format(F.from_utc_timestamp(F.col("updated"), zone), "yyyy-MM-dd'T'HH:mm:ss"),
                 F.lit("+03:00")).alias("created_at"),
        F.col("mag").alias("mag"),
        F.when(F.col("n") % 4 != 0, F.col("depth_km")).alias("depth"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col("lon"), F.col("lat"), F.col("depth_km")).alias("coordinates")).alias("geojson"),
        F.col("place").alias("title"),
        F.lit("Europe/Istanbul").alias("location_tz"),
        F.lit("kandilli").alias("provider"),
    )

    def envelope(items, no):
        odd = no % 2 == 1
        return F.struct(F.lit(True).alias("status"), F.lit("kandilli").alias("provider"),
                        F.when(~odd, items).alias("result"), F.when(odd, items).alias("results"))

    return _docs(q, item, envelope, block)
