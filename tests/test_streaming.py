"""Streaming forms equal their batch forms (availableNow runs over landed files)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("stream,batch", [
    ("stream_hourly_counts", "hourly_counts"),
    ("stream_ingest", "merge_usgs"),
    ("stream_candidates", "match_candidates"),
    ("stream_match", "mutual_best"),
    ("stream_mutual_best", "mutual_best"),
    ("merge_days_usgs", "merge_usgs"),
])
def test_stream_equals_batch(spark, stream, batch):
    q = E.queries()
    assert rows(q[stream](spark, SF_SMALL)) == rows(q[batch](spark, SF_SMALL))


def test_ingest_batch_reports_counts(spark):
    r = E.queries()["ingest_batch"](spark, SF_SMALL).first()
    assert r.status == "ok" and r.events_processed > 0 and 0 < r.rows_merged <= r.events_processed
