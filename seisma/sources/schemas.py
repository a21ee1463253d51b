"""Fixed table schemas and per-feed source specifications.

A feed is described by data (a ``SourceSpec``), not by code: the raw table
layout, the key and version columns, and how raw columns map to the staging
normal form.  A fourth feed is a new ``SourceSpec``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(cols: list[tuple[str, str]], required: tuple[str, ...] = ()) -> StructType:
    types = {"string": StringType(), "timestamp": TimestampType(), "double": DoubleType(), "bigint": LongType()}
    return StructType([StructField(n, types[t], n not in required) for n, t in cols])


# Raw table layouts (column order and types) per feed.
USGS_RAW_COLUMNS = [
    ("ingestion_id", "string"), ("ingestion_time", "timestamp"), ("event_id", "string"),
    ("event_time", "timestamp"), ("updated", "timestamp"), ("mag", "double"), ("mag_type", "string"),
    ("place", "string"), ("status", "string"), ("tsunami", "bigint"), ("sig", "bigint"), ("net", "string"),
    ("nst", "bigint"), ("dmin", "double"), ("rms", "double"), ("gap", "double"), ("type", "string"),
    ("alert", "string"), ("cdi", "double"), ("mmi", "double"), ("felt", "bigint"), ("lon", "double"),
    ("lat", "double"), ("depth_km", "double"), ("source_url", "string"), ("raw_json", "string"),
]
EMSC_RAW_COLUMNS = [
    ("ingestion_id", "string"), ("ingestion_time", "timestamp"), ("event_id", "string"),
    ("event_time", "timestamp"), ("updated", "timestamp"), ("mag", "double"), ("mag_type", "string"),
    ("place", "string"), ("lon", "double"), ("lat", "double"), ("depth_km", "double"),
    ("source_url", "string"), ("raw_json", "string"),
]
KANDILLI_RAW_COLUMNS = [
    ("ingestion_id", "string"), ("ingestion_time", "timestamp"), ("earthquake_id", "string"),
    ("date_time", "timestamp"), ("created_at", "timestamp"), ("mag", "double"), ("depth_km", "double"),
    ("lon", "double"), ("lat", "double"), ("title", "string"), ("location_tz", "string"),
    ("provider", "string"), ("epi_center_name", "string"), ("epi_center_population", "bigint"),
    ("closest_city_name", "string"), ("closest_city_distance_km", "double"),
    ("location_properties", "string"), ("raw_json", "string"),
]

# The eleven staging columns every feed is normalised to, in order.
STG_COMMON = [
    "earthquake_id", "source", "event_time", "mag", "depth_km", "lon", "lat", "place",
    "source_updated_at", "ingestion_time", "raw_json",
]

# Columns of the normalised in-flight event (superset of all feeds), with types.
EVENT_COLUMNS = [
    ("source", "string"), ("event_id", "string"), ("event_time", "timestamp"), ("updated", "timestamp"),
    ("created_at", "timestamp"), ("mag", "double"), ("mag_type", "string"), ("place", "string"),
    ("status", "string"), ("tsunami", "bigint"), ("sig", "bigint"), ("net", "string"), ("nst", "bigint"),
    ("dmin", "double"), ("rms", "double"), ("gap", "double"), ("event_type", "string"),
    ("alert", "string"), ("cdi", "double"), ("mmi", "double"), ("felt", "bigint"), ("lon", "double"),
    ("lat", "double"), ("depth_km", "double"), ("source_url", "string"), ("raw_json", "string"),
    ("location_tz", "string"), ("provider", "string"), ("epi_center_name", "string"),
    ("epi_center_population", "bigint"), ("closest_city_name", "string"),
    ("closest_city_distance_km", "double"), ("location_properties", "string"),
]
EVENT_SCHEMA = _schema(EVENT_COLUMNS)


@dataclass(frozen=True)
class SourceSpec:
    name: str
    raw_columns: list[tuple[str, str]]
    key: str
    version: str
    time_col: str
    # raw column <- in-flight event column, where the names differ
    from_event: dict[str, str] = field(default_factory=dict)
    # staging column <- raw column, where the names differ (others: same name)
    stg_renames: dict[str, str] = field(default_factory=dict)
    stg_extras: tuple[str, ...] = ()
    keep_on_update: tuple[str, ...] = ("raw_json",)

    @property
    def raw_schema(self) -> StructType:
        return _schema(self.raw_columns)

    @property
    def raw_names(self) -> list[str]:
        return [n for n, _ in self.raw_columns]

    @property
    def raw_types(self) -> dict[str, str]:
        return dict(self.raw_columns)

    def stg_columns(self) -> list[tuple[str, str]]:
        """(staging name, raw expression or literal marker) pairs, in output order."""
        out = []
        for c in STG_COMMON + list(self.stg_extras):
            out.append((c, self.stg_renames.get(c, c)))
        return out


USGS = SourceSpec(
    name="usgs",
    raw_columns=USGS_RAW_COLUMNS,
    key="event_id",
    version="updated",
    time_col="event_time",
    from_event={"type": "event_type"},
    stg_renames={"earthquake_id": "event_id", "source_updated_at": "updated", "event_type": "type"},
    stg_extras=("mag_type", "status", "tsunami", "sig", "net", "nst", "dmin", "rms", "gap",
                "event_type", "alert", "cdi", "mmi", "felt", "source_url"),
)
EMSC = SourceSpec(
    name="emsc",
    raw_columns=EMSC_RAW_COLUMNS,
    key="event_id",
    version="updated",
    time_col="event_time",
    stg_renames={"earthquake_id": "event_id", "source_updated_at": "updated"},
    stg_extras=("mag_type", "source_url"),
)
KANDILLI = SourceSpec(
    name="kandilli",
    raw_columns=KANDILLI_RAW_COLUMNS,
    key="earthquake_id",
    version="created_at",
    time_col="date_time",
    from_event={"earthquake_id": "event_id", "date_time": "event_time", "title": "place"},
    stg_renames={"event_time": "date_time", "place": "title", "source_updated_at": "created_at"},
    stg_extras=("location_tz", "provider", "epi_center_name", "epi_center_population",
                "closest_city_name", "closest_city_distance_km", "location_properties"),
)
SPECS = {s.name: s for s in (USGS, EMSC, KANDILLI)}


def spec_for(source: str) -> SourceSpec:
    try:
        return SPECS[source]
    except KeyError:
        raise ValueError(f"Unknown source: {source}") from None


# --- feed documents (nested JSON as delivered by the three feeds) -----------------
# Leaves are read as text and coerced by the parsers, so a number sent as text is not lost.

USGS_FEATURE = StructType([
    StructField("type", StringType()),
    StructField("id", StringType()),
    StructField("geometry", StructType([
        StructField("type", StringType()),
        StructField("coordinates", ArrayType(StringType())),
    ])),
    StructField("properties", StructType([
        StructField("mag", StringType()), StructField("place", StringType()),
        StructField("time", StringType()), StructField("updated", StringType()),
        StructField("tz", StringType()), StructField("url", StringType()),
        StructField("detail", StringType()), StructField("felt", StringType()),
        StructField("cdi", StringType()), StructField("mmi", StringType()),
        StructField("alert", StringType()), StructField("status", StringType()),
        StructField("tsunami", StringType()), StructField("sig", StringType()),
        StructField("net", StringType()), StructField("code", StringType()),
        StructField("ids", StringType()), StructField("sources", StringType()),
        StructField("types", StringType()), StructField("nst", StringType()),
        StructField("dmin", StringType()), StructField("rms", StringType()),
        StructField("gap", StringType()), StructField("magType", StringType()),
        StructField("type", StringType()), StructField("title", StringType()),
    ])),
])
USGS_DOC = StructType([
    StructField("type", StringType()),
    StructField("metadata", StructType([
        StructField("generated", LongType()), StructField("url", StringType()),
        StructField("title", StringType()), StructField("api", StringType()),
        StructField("count", IntegerType()),
    ])),
    StructField("features", ArrayType(USGS_FEATURE)),
])

EMSC_FEATURE = StructType([
    StructField("type", StringType()),
    StructField("id", StringType()),
    StructField("properties", StructType([
        StructField("source_id", StringType()), StructField("unid", StringType()),
        StructField("mag", StringType()), StructField("magtype", StringType()),
        StructField("time", StringType()), StructField("lastupdate", StringType()),
        StructField("lat", StringType()), StructField("lon", StringType()),
        StructField("depth", StringType()), StructField("flynn_region", StringType()),
        StructField("evtype", StringType()),
    ])),
])
EMSC_DOC = StructType([StructField("type", StringType()), StructField("features", ArrayType(EMSC_FEATURE))])

KANDILLI_ITEM = StructType([
    StructField("earthquake_id", StringType()), StructField("date_time", StringType()),
    StructField("created_at", StringType()), StructField("mag", StringType()),
    StructField("depth", StringType()),
    StructField("geojson", StructType([
        StructField("type", StringType()), StructField("coordinates", ArrayType(StringType())),
    ])),
    StructField("title", StringType()), StructField("location_tz", StringType()),
    StructField("provider", StringType()), StructField("epi_center_name", StringType()),
    StructField("epi_center_population", StringType()), StructField("closest_city_name", StringType()),
    StructField("closest_city_distance_km", StringType()),
    StructField("location_properties", StringType()),
])
KANDILLI_DOC = StructType([
    StructField("status", BooleanType()), StructField("timestamp", StringType()),
    StructField("provider", StringType()), StructField("count", IntegerType()),
    StructField("result", ArrayType(KANDILLI_ITEM)), StructField("results", ArrayType(KANDILLI_ITEM)),
])

# Job log (warehouse job history) consumed by the cost fact.
JOB_LOG_COLUMNS = [
    ("job_id", "string"), ("job_type", "string"), ("statement_type", "string"), ("query", "string"),
    ("destination_table", "string"), ("total_bytes_processed", "bigint"), ("start_time", "timestamp"),
    ("end_time", "timestamp"), ("creation_time", "timestamp"), ("error_result", "string"),
    ("cache_hit", "boolean"),
]
