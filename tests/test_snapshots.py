"""Snapshot tables: versions, crashes at every step, concurrent writers, touched days, incremental builds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_safety import day, raw

from seisma.operators.snapshots import DayTable, SnapshotConflict
from seisma.operators.upsert import merge_into_days, merge_snapshot
from seisma.operators.sinks import write_days
from seisma.plans import models
from seisma.plans.ingest import ingest_batch
from seisma.session import scratch_path
from seisma.sources.schemas import SPECS

SPEC = SPECS["usgs"]


def dated(df, spec=SPEC):
    return df.withColumn("event_date", F.to_date(spec.time_col))


def table(spark, rows, spec=SPEC):
    t = DayTable(spark, scratch_path(spark, "snapshot"))
    t.create(dated(raw(spark, spec, rows), spec))
    return t


def keys(t, version=None, spec=SPEC, days=None):
    return sorted(((r[spec.key], r[spec.time_col], r[spec.version]) for r in t.read(version, days).collect()), key=str)


FIRST = [("a", day(1), day(1)), ("b", day(1), day(1)), ("c", day(2), day(2)), ("d", day(3), day(3)), ("n", None, day(1))]
BATCH = [("a", day(5), day(9)), ("e", day(2), day(4)), ("d", day(3), day(1)), ("n", day(7), day(8)), ("", day(1), day(1)), (None, day(1), day(1))]
AFTER = sorted([("a", day(5), day(9)), ("b", day(1), day(1)), ("c", day(2), day(2)), ("d", day(3), day(3)), ("e", day(2), day(4)), ("n", day(7), day(8))], key=str)


def test_merge_makes_one_new_version_of_the_changed_days(spark):
    t = table(spark, FIRST)
    counts = merge_snapshot(t, raw(spark, SPEC, BATCH), SPEC).first()
    assert (counts.rows_inserted, counts.rows_updated, counts.rows_affected) == (1, 2, 3)
    assert keys(t) == AFTER and keys(t, 0) == sorted(FIRST, key=str)
    # day 3 was hit by an older version of d, so it keeps its folder; the NULL day lost its only row
    assert set(t.changed_since(0)) == {day(1).date(), day(2).date(), day(5).date(), day(7).date(), None}
    assert None in t.days(0) and None not in t.days()
    assert keys(t, days=[day(3).date(), day(30).date()]) == [("d", day(3), day(3))]
    assert spark.read.parquet(f"{t.root}_rejected").count() == 2
    assert merge_snapshot(t, raw(spark, SPEC, BATCH), SPEC).first().rows_affected == 0 and t.versions() == [0, 1]
    assert spark.read.parquet(f"{t.root}_rejected").count() == 2


@pytest.mark.parametrize("feed", ["usgs", "emsc", "kandilli"])
def test_equals_the_merge_in_place(spark, feed):
    spec = SPECS[feed]
    t, path = table(spark, FIRST, spec), scratch_path(spark, "in-place")
    write_days(dated(raw(spark, spec, FIRST), spec), path, "event_date", cluster_by=None, overwrite_all=True)
    a = merge_snapshot(t, raw(spark, spec, BATCH), spec).first()
    b = merge_into_days(spark, path, raw(spark, spec, BATCH), spec).first()
    cols = [c for c, _ in spec.raw_columns]
    assert a == b and sorted(map(str, t.read().select(*cols).collect())) == sorted(map(str, spark.read.parquet(path).select(*cols).collect()))


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["_write", "after_write", "_publish", "_rename", "after_rename"])
def test_a_crash_leaves_the_old_or_the_new_table(spark, monkeypatch, step):
    t = table(spark, FIRST)
    name = {"after_write": "_write", "after_rename": "_rename"}.get(step, step)
    real = getattr(DayTable, name)

    def dies(self, *a):
        if step.startswith("after"):
            real(self, *a)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(DayTable, name, dies)
        with pytest.raises(Killed):
            merge_snapshot(t, raw(spark, SPEC, BATCH), SPEC)
    assert keys(DayTable(spark, t.root)) == (AFTER if step == "after_rename" else sorted(FIRST, key=str))
    merge_snapshot(t, raw(spark, SPEC, BATCH), SPEC)  # the batch is repeated
    assert keys(t) == AFTER and t.versions() == [0, 1]
    gone = t.vacuum(keep=1, older_than=dt.timedelta(0))
    assert len(gone) >= (step in ("after_write", "_publish", "_rename")) and keys(t) == AFTER and t.versions() == [1]


def test_the_second_of_two_writers_is_refused(spark):
    t = table(spark, FIRST)
    x, y = dated(raw(spark, SPEC, [("x", day(9), day(9))])), dated(raw(spark, SPEC, [("y", day(9), day(9))]))
    t.replace(x, [day(9).date()], 0)
    with pytest.raises(SnapshotConflict):
        t.replace(y, [day(9).date()], 0)
    assert ("x", day(9), day(9)) in keys(t) and ("y", day(9), day(9)) not in keys(t)
    with pytest.raises(ValueError):
        t.replace(x, [day(8).date()], 1)  # rows of a day that is not replaced
    assert t.versions() == [0, 1]


def test_first_merge_and_empty_tables(spark):
    t = DayTable(spark, scratch_path(spark, "none"))
    assert t.version() is None and t.days() == [] and t.vacuum() == []
    with pytest.raises(ValueError):
        t.read()
    assert merge_snapshot(t, raw(spark, SPEC, FIRST), SPEC).first().rows_inserted == 4  # the row without a time is quarantined
    assert len(keys(t)) == 4
    e = table(spark, [])
    assert keys(e) == [] and e.read().columns[-1] == "event_date"
    assert merge_snapshot(e, raw(spark, SPEC, BATCH), SPEC).first().rows_inserted == 4


def test_only_touched_days_are_read(spark):
    t = table(spark, FIRST)
    merge_snapshot(t, raw(spark, SPEC, BATCH), SPEC)
    changed = [d for d in t.changed_since(0) if d is not None]
    files = t.read(days=changed).inputFiles()
    assert files and all(any(f"event_date={d}" in f for d in changed) for f in files)
    assert not any("event_date=2030-05-03" in f for f in files)


def test_incremental_build_equals_a_full_one(spark, monkeypatch):
    rows = {f: [(f"{f}{i}", day(1 + i % 20, i % 24), day(1)) for i in range(60)] for f in SPECS}
    more = {f: [(f"{f}{i}", day(1 + i % 3, 5), day(2)) for i in range(0, 8, 2)] + [(f"{f}x", day(20), day(1))] for f in SPECS}
    raws = {f: table(spark, rows[f], SPECS[f]) for f in SPECS}
    as_of, root = day(21), scratch_path(spark, "build")
    models.build_days(spark, raws, root, as_of)
    for f in SPECS:
        merge_snapshot(raws[f], raw(spark, SPECS[f], more[f]), SPECS[f])
    touched = set(raws["usgs"].changed_since(0))
    read = []
    real = DayTable.read
    monkeypatch.setattr(DayTable, "read", lambda self, version=None, days=None: read.append((self.root, days)) or real(self, version, days))
    got = models.build_days(spark, raws, root, as_of)
    monkeypatch.undo()
    assert [set(d) for r, d in read if r == raws["usgs"].root] == [touched] and 0 < len(touched) < 20
    want = models.build_days(spark, raws, scratch_path(spark, "build"), as_of)
    for name in want:
        assert sorted(map(str, got[name].read().collect())) == sorted(map(str, want[name].read().collect())), name
    assert len(got["stg_usgs"].read().collect()) == 61
    before = {n: t.version() for n, t in got.items() if n != "fct_unified"}
    again = models.build_days(spark, raws, root, as_of)  # nothing new: nothing is staged again
    assert {n: t.version() for n, t in again.items() if n != "fct_unified"} == before


def test_ingest_into_a_snapshot_table_keeps_rejected_items(spark):
    spec = SPECS["kandilli"]
    t = table(spark, [], spec)
    item = '{"earthquake_id": "%s", "date_time": "%s", "mag": 2.5, "geojson": {"coordinates": [1, 2]}}'
    doc = '{"status": true, "result": [%s, %s]}' % (item % ("k1", "2030-05-01 10:00:00"), item % ("k2", "yesterday"))
    docs = spark.createDataFrame([(doc,)], "doc string")
    for _ in range(2):
        r = ingest_batch(spark, docs, "kandilli", t, "i1", day(2)).first()
        assert (r.status, r.events_processed) == ("ok", 1)
    assert [k for k, *_ in keys(t, spec=spec)] == ["k1"] and t.version() == 1
    rejected = spark.read.parquet(f"{t.root}_rejected_items").collect()
    assert [(x.event_id, x.reject_reason) for x in rejected] == [("k2", "unparseable date_time")]
