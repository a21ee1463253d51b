"""Property tests: blocking geometry never changes the result; parsers never raise."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import events
from seisma.functions.times import parse_iso_utc, parse_local_ts
from seisma.operators.matching import MatchConfig, match_candidates
from test_matching import naive_candidates

BASE = dt.datetime(2026, 7, 15, 12)

event = st.tuples(
    st.floats(0, 600), st.floats(-1.0, 1.0), st.floats(179.0, 181.0), st.one_of(st.none(), st.floats(2, 4)),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=st.lists(event, min_size=1, max_size=25),
    right=st.lists(event, min_size=1, max_size=25),
    bucket=st.integers(1, 900),
    cell=st.floats(0.05, 3.0),
    max_seconds=st.integers(0, 200),
    max_km=st.floats(1, 120),
)
def test_blocking_is_exact_for_any_geometry(spark, left, right, bucket, cell, max_seconds, max_km):
    def rows(prefix, evs):
        return [(f"{prefix}{i}", (BASE + dt.timedelta(seconds=s)).isoformat(sep=" "), m,
                 (lon + 180) % 360 - 180, lat) for i, (s, lat, lon, m) in enumerate(evs)]

    L, R = events(spark, rows("u", left)), events(spark, rows("k", right))
    cfg = MatchConfig(max_seconds=max_seconds, max_km=max_km, time_bucket_seconds=bucket, lat_cell_deg=cell)
    key = ["usgs_id", "kandilli_id"]
    got = {tuple(r) for r in match_candidates(L, R, cfg).select(*key).collect()}
    exp = {tuple(r) for r in naive_candidates(L, R, cfg).select(*key).collect()}
    assert got == exp


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=30), min_size=1, max_size=40))
def test_time_parsers_never_raise(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    out = df.select(parse_local_ts("v").alias("a"), parse_iso_utc("v").alias("b")).collect()
    assert len(out) == len(texts)
