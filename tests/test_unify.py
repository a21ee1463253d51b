"""Canonical value selection of the unified table."""

import datetime as dt

from conftest import events
from seisma.operators.matching import reconcile
from seisma.operators.unify import unified_columns, unify_events

D = "2026-07-15 "
AS_OF = dt.datetime(2026, 7, 16)


def unify(spark, left, right):
    return {r.unified_id: r for r in unify_events(reconcile(events(spark, left), events(spark, right)), AS_OF).collect()}


def test_matched_in_region_prefers_local_source(spark):
    res = unify(spark, [("u1", D + "12:00:00", 4.8, 35.0, 39.0)], [("k1", D + "12:00:30", 4.5, 35.01, 39.01)])
    r = res["unified_k1"]
    assert (r.canonical_lat, r.canonical_lon, r.canonical_mag) == (39.01, 35.01, 4.5)
    assert r.event_time == dt.datetime(2026, 7, 15, 12, 0, 0)  # time is always left-first
    assert r.mag_disagreement == 0.3 and r.sources_available == "both" and r.time_diff_seconds == 30
    assert r.distance_km is not None and r.processed_at == AS_OF


def test_matched_outside_region_prefers_left_source(spark):
    res = unify(spark, [("u1", D + "12:00:00", 4.8, 10.0, 10.0)], [("k1", D + "12:00:30", 4.5, 10.01, 10.01)])
    r = res["unified_u1"]
    assert (r.canonical_lat, r.canonical_lon, r.canonical_mag) == (10.0, 10.0, 4.8)


def test_single_source_rows(spark):
    res = unify(spark, [("u1", D + "12:00:00", 4.8, 35.0, 39.0)], [("k9", D + "18:00:00", 3.0, 35.0, 39.0)])
    u, k = res["unified_u1"], res["unified_k9"]
    assert (u.sources_available, k.sources_available) == ("usgs", "kandilli")
    assert u.mag_disagreement is None and u.distance_km is None and u.time_diff_seconds is None
    assert (k.canonical_mag, k.canonical_lat) == (3.0, 39.0)


def test_region_box_edges_inclusive(spark):
    for lat, lon, inside in [(35.0, 25.0, True), (43.0, 46.0, True), (34.99, 30.0, False), (40.0, 46.01, False)]:
        res = unify(spark, [("u1", D + "12:00:00", 4.8, lon, lat)], [("k1", D + "12:00:01", 4.7, lon, lat)])
        assert ("unified_k1" in res) == inside


def test_column_order(spark):
    df = unify_events(reconcile(events(spark, []), events(spark, [])), AS_OF)
    assert df.columns == unified_columns()
