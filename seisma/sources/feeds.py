"""Feed adapters: nested JSON feed documents -> normalised events -> raw rows.

Each parser takes a DataFrame with one JSON document per row (column ``doc``),
so documents can come from files (``read_docs``), a streaming source, or any
DataFrame.  Parsing is ``from_json`` with a fixed schema + ``explode``; no
Python runs per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from seisma.functions.times import epoch_ms_to_ts, parse_iso_utc, parse_local_ts

from seisma.sources.schemas import (
    EMSC_FEATURE,
    EVENT_COLUMNS,
    KANDILLI_DOC,
    KANDILLI_ITEM,
    USGS_FEATURE,
    SourceSpec,
)

KANDILLI_ENVELOPE = StructType([
    StructField("status", BooleanType()),
    StructField("result", ArrayType(StringType())),
    StructField("results", ArrayType(StringType())),
])

_EVENT_TYPES = dict(EVENT_COLUMNS)


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON document file: ``doc`` (text) and ``path``."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("value").alias("doc"), F.col("_metadata.file_path").alias("path"))
    )


def _items(docs: DataFrame, field: str, item_schema) -> DataFrame:
    """Explode a document's item array keeping each item's original JSON text (``_raw``).

    The array is first read as text elements (a STRING field over a JSON
    object yields the object's text), then each element is parsed with the
    item schema: ``raw_json`` is the item as delivered, not a re-serialisation.
    """
    env = StructType([StructField(field, ArrayType(StringType()))])
    raw = docs.select(F.explode(F.from_json("doc", env).getField(field)).alias("_raw"))
    return raw.select("_raw", F.from_json("_raw", item_schema).alias("_i")).select("_raw", "_i.*")


def _events(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Project to the full normalised event layout (missing fields as typed NULLs)."""
    out = []
    for name, typ in EVENT_COLUMNS:
        expr = cols.get(name)
        out.append((F.lit(None).cast(typ) if expr is None else _coerced(expr, typ)).alias(name))
    return df.select(*out)


def _coerced(c: Column, typ) -> Column:
    """``c`` as ``typ`` where no information is lost (``'12.0'`` is an integer, ``'12.5'`` and ``'x'`` are NULL)."""
    if str(typ) not in ("bigint", "int"):
        return c.try_cast(typ)
    whole = c.try_cast("double")
    return F.coalesce(c.try_cast(typ), F.when(whole == F.floor(whole), F.floor(whole).try_cast(typ)))


def unreadable(docs: DataFrame) -> DataFrame:
    """Documents that are no JSON (an error page, a cut-off answer); the strict parsers fail on them."""
    return docs.where(F.col("doc").isNotNull() & F.try_parse_json("doc").isNull())


def _readable(docs: DataFrame, strict: bool) -> DataFrame:
    ok = F.col("doc").isNull() | F.try_parse_json("doc").isNotNull()
    if not strict:
        return docs.where(ok)
    return docs.withColumn("doc", F.when(ok, F.col("doc")).otherwise(
        F.raise_error(F.concat(F.lit("unreadable feed document: "), F.substring("doc", 1, 40)))))


def parse_usgs(docs: DataFrame, strict: bool = True) -> DataFrame:
    """FeatureCollection -> events.  Missing ``features`` -> no rows; NULL times are kept.

    A document that is no JSON fails the job; with ``strict=False`` it is skipped (see ``unreadable``).
    """
    f = _items(_readable(docs, strict), "features", USGS_FEATURE)
    p = F.col("properties")
    coords = F.col("geometry.coordinates")
    return _events(f, {
        "source": F.lit("usgs"),
        "event_id": F.coalesce(F.col("id"), F.lit("")),
        "event_time": epoch_ms_to_ts(p.getField("time")),
        "updated": epoch_ms_to_ts(p.getField("updated")),
        "mag": p.getField("mag"),
        "mag_type": p.getField("magType"),
        "place": p.getField("place"),
        "status": p.getField("status"),
        "tsunami": p.getField("tsunami"),
        "sig": p.getField("sig"),
        "net": p.getField("net"),
        "nst": p.getField("nst"),
        "dmin": p.getField("dmin"),
        "rms": p.getField("rms"),
        "gap": p.getField("gap"),
        "event_type": p.getField("type"),
        "alert": p.getField("alert"),
        "cdi": p.getField("cdi"),
        "mmi": p.getField("mmi"),
        "felt": p.getField("felt"),
        "lon": F.get(coords, 0),
        "lat": F.get(coords, 1),
        "depth_km": F.get(coords, 2),
        "source_url": p.getField("url"),
        "raw_json": F.col("_raw"),
    })


def parse_emsc(docs: DataFrame, keep_rejects: bool = False, strict: bool = True) -> DataFrame:
    """Properties-only features -> events; rows whose time does not parse are dropped.

    With ``keep_rejects`` they are kept with a ``reject_reason`` instead (see
    ``split_rejects``), so a run can quarantine them rather than lose them.
    """
    f = _items(_readable(docs, strict), "features", EMSC_FEATURE)
    p = F.col("properties")
    blank = lambda c: F.nullif(c, F.lit(""))
    ev = _events(f, {
        "source": F.lit("emsc"),
        "event_id": F.coalesce(blank(p.getField("source_id")), blank(p.getField("unid")), F.lit("")),
        "event_time": parse_iso_utc(p.getField("time")),
        "updated": parse_iso_utc(p.getField("lastupdate")),
        "mag": p.getField("mag"),
        "mag_type": p.getField("magtype"),
        "place": p.getField("flynn_region"),
        "event_type": p.getField("evtype"),
        "lon": p.getField("lon"),
        "lat": p.getField("lat"),
        "depth_km": p.getField("depth"),
        "raw_json": F.col("_raw"),
    })
    return _rejects(ev, "unparseable time", keep_rejects)


def _rejects(ev: DataFrame, reason: str, keep: bool) -> DataFrame:
    if not keep:
        return ev.where(F.col("event_time").isNotNull())
    return ev.withColumn("reject_reason", F.when(F.col("event_time").isNull(), F.lit(reason)))


def split_rejects(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted events, quarantined rows) of a parse run with ``keep_rejects``."""
    bad = F.col("reject_reason").isNotNull()
    return ev.where(~bad).drop("reject_reason"), ev.where(bad)


def kandilli_rejected(docs: DataFrame) -> DataFrame:
    """Documents whose envelope is not ``status == true`` (the parser rejects them)."""
    d = docs.select("*", F.from_json("doc", KANDILLI_DOC).alias("_d"))
    return d.where(~F.coalesce(F.col("_d.status"), F.lit(False))).drop("_d")


def parse_kandilli(docs: DataFrame, zone: str = "Europe/Istanbul", strict: bool = True,
                   keep_rejects: bool = False) -> DataFrame:
    """Envelope ``{status, result[]}`` -> events.

    Items = first non-empty of ``result``/``results``.  Depth = item ``depth``
    unless NULL, else the third coordinate (0.0 kept).  Items whose
    ``date_time`` does not parse are dropped.  With ``strict`` an envelope
    whose status is not true fails the job (``raise_error``), as in the feed
    client; otherwise such documents are skipped (see ``kandilli_rejected``).
    """
    d = F.from_json("doc", KANDILLI_ENVELOPE)
    ok = F.coalesce(d.getField("status"), F.lit(False))
    docs = docs.select(
        F.when(ok, d).otherwise(F.raise_error(F.lit("Kandilli response status is not true"))).alias("d")
        if strict else d.alias("d")
    )
    if not strict:
        docs = docs.where(F.coalesce(F.col("d.status"), F.lit(False)))
    res, alt = F.col("d.result"), F.col("d.results")
    items = F.when(F.size(res) > 0, res).otherwise(F.coalesce(alt, F.array()))
    it = docs.select(F.explode(items).alias("_raw")).select(
        "_raw", F.from_json("_raw", KANDILLI_ITEM).alias("i")).select("_raw", "i.*")
    coords = F.col("geojson.coordinates")
    # str() of the id: an absent id is '', an explicit JSON null is the text 'None'.
    present = F.array_contains(F.json_object_keys("_raw"), "earthquake_id")
    ev = _events(it, {
        "source": F.lit("kandilli"),
        "event_id": F.when(F.col("earthquake_id").isNotNull(), F.col("earthquake_id"))
        .when(present, F.lit("None")).otherwise(F.lit("")),
        "event_time": parse_local_ts(F.col("date_time"), zone),
        "created_at": parse_local_ts(F.col("created_at"), zone),
        "mag": F.col("mag"),
        "depth_km": F.coalesce(F.col("depth").try_cast("double"), F.get(coords, 2).try_cast("double")),
        "lon": F.get(coords, 0),
        "lat": F.get(coords, 1),
        "place": F.col("title"),
        "location_tz": F.col("location_tz"),
        "provider": F.col("provider"),
        "epi_center_name": F.col("epi_center_name"),
        "epi_center_population": F.col("epi_center_population"),
        "closest_city_name": F.col("closest_city_name"),
        "closest_city_distance_km": F.col("closest_city_distance_km"),
        "location_properties": F.col("location_properties"),
        "raw_json": F.col("_raw"),
    })
    return _rejects(ev, "unparseable date_time", keep_rejects)


PARSERS = {"usgs": parse_usgs, "emsc": parse_emsc, "kandilli": parse_kandilli}


def to_raw(events: DataFrame, spec: SourceSpec, ingestion_id: str | Column | None = None,
           ingestion_time: dt.datetime | Column | None = None) -> DataFrame:
    """Shape normalised events into the feed's raw table layout.

    ``ingestion_id`` / ``ingestion_time`` are *one literal per batch* (not a
    per-row uuid); when omitted the events' own columns are used.
    """
    have = set(events.columns)
    out = []
    for name, typ in spec.raw_columns:
        src = spec.from_event.get(name, name)
        if name == "ingestion_id" and ingestion_id is not None:
            e = ingestion_id if isinstance(ingestion_id, Column) else F.lit(ingestion_id)
        elif name == "ingestion_time" and ingestion_time is not None:
            e = ingestion_time if isinstance(ingestion_time, Column) else F.lit(ingestion_time)
        elif src in have:
            e = F.col(src)
        else:
            e = F.lit(None)
        out.append(e.cast(typ).alias(name))
    return events.select(*out)
