"""MERGE semantics: strictly newer wins, NULL versions never update, raw_json kept, idempotent."""

import datetime as dt

from pyspark.sql import functions as F

from seisma.operators.upsert import merge_into_days, upsert, upsert_counts
from seisma.operators.sinks import table_path, write_days
from seisma.sources.schemas import SourceSpec

SCHEMA = "event_id string, event_time timestamp, updated timestamp, ingestion_time timestamp, mag double, raw_json string"


def t(h, d=1):
    return dt.datetime(2024, 1, d, h)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def as_map(df):
    return {r.event_id: r for r in df.collect()}


def test_upsert_semantics(spark):
    target = frame(spark, [
        ("a", t(1), t(2), t(2), 1.0, "a#1"),
        ("b", t(1), t(2), t(2), 1.0, "b#1"),
        ("c", t(1), None, t(2), 1.0, "c#1"),
        ("d", t(1), t(5), t(2), 1.0, "d#1"),
    ])
    batch = frame(spark, [
        ("a", t(3), t(4), t(4), 2.0, "a#2"),   # newer -> update, raw_json kept
        ("b", t(1), None, t(4), 2.0, "b#2"),   # NULL batch version -> no update
        ("c", t(1), t(9), t(4), 2.0, "c#2"),   # NULL target version -> no update
        ("d", t(1), t(5), t(4), 2.0, "d#2"),   # equal version -> no update
        ("e", t(1), t(1), t(4), 2.0, "e#1"),   # new key -> insert
        ("e", t(1), t(2), t(4), 3.0, "e#2"),   # two versions in one batch: newest wins
    ])
    out = as_map(upsert(target, batch, "event_id", "updated"))
    assert out["a"].mag == 2.0 and out["a"].raw_json == "a#1" and out["a"].event_time == t(3)
    assert out["b"].mag == 1.0 and out["c"].mag == 1.0 and out["d"].mag == 1.0
    assert out["e"].mag == 3.0 and out["e"].raw_json == "e#2"
    c = upsert_counts(target, batch, "event_id", "updated").first()
    assert (c.rows_inserted, c.rows_updated, c.rows_deleted, c.rows_affected) == (1, 1, 0, 2)


def test_upsert_is_idempotent(spark):
    target = frame(spark, [("a", t(1), t(2), t(2), 1.0, "a#1")])
    batch = frame(spark, [("a", t(3), t(4), t(4), 2.0, "a#2"), ("z", t(3), t(4), t(4), 2.0, "z#1")])
    once = upsert(target, batch, "event_id", "updated")
    twice = upsert(once, batch, "event_id", "updated")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    c = upsert_counts(once, batch, "event_id", "updated").first()
    assert c.rows_affected == 0


def test_merge_into_days_moves_event_between_days(spark):
    path = table_path(spark, "merge-days-test")
    target = frame(spark, [("a", t(1, 1), t(2, 1), t(2, 1), 1.0, "a#1"), ("b", t(1, 2), t(2, 2), t(2, 2), 1.0, "b#1")])
    write_days(target.withColumn("event_date", F.to_date("event_time")), path, "event_date", cluster_by=None,
               overwrite_all=True)
    # "a" is corrected to another day; its old day becomes empty and must vanish.
    batch = frame(spark, [("a", t(1, 3), t(5, 3), t(5, 3), 2.0, "a#2")])
    spec = SourceSpec(name="t", raw_columns=[], key="event_id", version="updated", time_col="event_time")
    counts = merge_into_days(spark, path, batch, spec).first()
    assert counts.rows_updated == 1
    out = spark.read.parquet(path)
    rows = {r.event_id: r for r in out.collect()}
    assert len(rows) == 2 and out.count() == 2
    assert str(rows["a"].event_date) == "2024-01-03" and rows["a"].raw_json == "a#1"
    days = {str(r.event_date) for r in out.select("event_date").distinct().collect()}
    assert days == {"2024-01-02", "2024-01-03"}
