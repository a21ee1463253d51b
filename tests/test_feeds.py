"""Feed parsers on self-written documents and the time parsers."""

import datetime as dt
import json

import pytest
from pyspark.sql.utils import AnalysisException  # noqa: F401

from seisma.functions.times import parse_iso_utc, parse_local_ts
from seisma.sources.feeds import parse_emsc, parse_kandilli, parse_usgs, to_raw
from seisma.sources.schemas import KANDILLI, USGS


def docs(spark, *objs):
    return spark.createDataFrame([(json.dumps(o),) for o in objs], "doc string")


USGS_DOC = {
    "type": "FeatureCollection",
    "features": [
        {"type": "Feature", "id": "sx0091", "geometry": {"type": "Point", "coordinates": [-70.75, -19.4, 33.25]},
         "properties": {"mag": 6.03, "place": "off the coast", "time": 1583020799123, "updated": 1583024399000,
                        "felt": None, "cdi": None, "gap": 112, "magType": "mb", "type": "earthquake",
                        "tsunami": 1, "sig": 559}},
        {"type": "Feature", "id": None, "geometry": None, "properties": {"mag": None, "time": None}},
    ],
}


def test_parse_usgs(spark):
    out = {r.event_id: r for r in parse_usgs(docs(spark, USGS_DOC)).collect()}
    assert set(out) == {"sx0091", ""}  # NULL-time rows are kept
    a, b = out["sx0091"], out[""]
    assert (a.mag, a.lon, a.lat, a.depth_km, a.gap, a.mag_type) == (6.03, -70.75, -19.4, 33.25, 112.0, "mb")
    assert a.event_time == dt.datetime(2020, 2, 29, 23, 59, 59, 123000)
    assert b.lon is None and b.event_time is None
    assert parse_usgs(docs(spark, {"type": "FeatureCollection"})).count() == 0
    raw = to_raw(parse_usgs(docs(spark, USGS_DOC)), USGS, "batch-1", dt.datetime(2020, 3, 1)).first()
    assert raw.ingestion_id == "batch-1" and "type" in raw.asDict()


def test_parse_emsc(spark):
    d = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"source_id": "77", "mag": 2.45, "magtype": "mw", "time": "2021-11-03T04:05:06.5Z",
                                           "lat": -3.5, "lon": 129.25, "depth": 60.0, "flynn_region": "BANDA SEA", "evtype": "ke"}},
        {"type": "Feature", "properties": {"source_id": "", "unid": "alt-4", "time": 1583020799000, "lastupdate": "2020-03-01T00:10:00Z"}},
        {"type": "Feature", "properties": {"source_id": "bad", "time": "soon"}},
    ]}
    out = {r.event_id: r for r in parse_emsc(docs(spark, d)).collect()}
    assert set(out) == {"77", "alt-4"}  # unparseable time -> dropped
    assert out["77"].event_time == dt.datetime(2021, 11, 3, 4, 5, 6, 500000) and out["77"].place == "BANDA SEA"
    assert out["alt-4"].event_time == dt.datetime(2020, 2, 29, 23, 59, 59)
    assert out["alt-4"].updated == dt.datetime(2020, 3, 1, 0, 10)


def test_parse_kandilli(spark):
    d = {"status": True, "result": [
        {"earthquake_id": "a7", "date_time": "2022-01-15 02:30:00", "created_at": "2022.01.15 02:41:30", "mag": 3.3, "depth": 0.0,
         "geojson": {"coordinates": [30.5, 36.75, 21.0]}, "title": "ŞEHİR", "epi_center_population": 5, "location_properties": json.dumps({"z": 2})},
        {"earthquake_id": "b8", "date_time": 1583020799000, "mag": 1.5, "geojson": {"coordinates": [30.5, 36.75, 21.0]}},
        {"earthquake_id": "c9", "date_time": None, "mag": 1.0},
    ]}
    out = {r.event_id: r for r in parse_kandilli(docs(spark, d)).collect()}
    assert set(out) == {"a7", "b8"}
    assert out["a7"].event_time == dt.datetime(2022, 1, 14, 23, 30) and out["a7"].depth_km == 0.0
    assert out["a7"].place == "ŞEHİR" and out["b8"].depth_km == 21.0
    assert out["b8"].event_time == dt.datetime(2020, 2, 29, 23, 59, 59)
    alt = {"status": True, "result": [], "results": [{"earthquake_id": "d1", "date_time": "2022-01-15 02:30:00"}]}
    assert [r.event_id for r in parse_kandilli(docs(spark, alt)).collect()] == ["d1"]


def test_parse_kandilli_bad_envelope(spark):
    bad = docs(spark, {"status": False, "result": []})
    with pytest.raises(Exception):
        parse_kandilli(bad).collect()
    assert parse_kandilli(bad, strict=False).count() == 0


CASES = [
    ("2024-06-27 18:45:00", "2024-06-27 15:45:00", "2024-06-27 18:45:00"),
    ("2024.06.27 18:45:00", "2024-06-27 15:45:00", None),
    ("2024-06-27T18:45:00", "2024-06-27 15:45:00", "2024-06-27 18:45:00"),
    ("2024-06-27T18:45:00+03:00", "2024-06-27 15:45:00", "2024-06-27 15:45:00"),
    ("1719503100000", "2024-06-27 15:45:00", "2024-06-27 15:45:00"),
    ("2024-06-27T18:45:00Z", "2024-06-27 18:45:00", "2024-06-27 18:45:00"),
    ("2015-01-10 12:00:00", "2015-01-10 10:00:00", "2015-01-10 12:00:00"),
    ("junk", None, None),
    (None, None, None),
    ("2024-13-01 00:00:00", None, None),
]


def test_time_parsers(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "v string")
    got = {r.v: (r.loc, r.iso) for r in df.select("v", parse_local_ts("v").alias("loc"),
                                                    parse_iso_utc("v").alias("iso")).collect()}
    for v, loc, iso in CASES:
        exp = tuple(dt.datetime.fromisoformat(x) if x else None for x in (loc, iso))
        assert got[v] == exp, v


def test_quarantine_keeps_rejected_rows(spark):
    from seisma.sources.feeds import split_rejects

    d = {"status": True, "result": [{"earthquake_id": "k1", "date_time": "2024-06-27 18:45:00"},
                                    {"earthquake_id": "k2", "date_time": "yesterday"}]}
    good, bad = split_rejects(parse_kandilli(docs(spark, d), keep_rejects=True))
    assert [r.event_id for r in good.collect()] == ["k1"] and "reject_reason" not in good.columns
    assert [(r.event_id, r.reject_reason) for r in bad.collect()] == [("k2", "unparseable date_time")]
