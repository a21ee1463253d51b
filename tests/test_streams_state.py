"""Incremental mutual best and late rows: equal to the batch results, whatever the order of arrival."""

import datetime as dt
import random

from pyspark.sql import functions as F

from seisma.operators.matching import mutual_best
from seisma.operators.snapshots import DayTable
from seisma.session import scratch_path
from seisma.streaming import jobs as J

PAIR = ("usgs_id string, kandilli_id string, usgs_time timestamp, kandilli_time timestamp, usgs_mag double, kandilli_mag double, usgs_lon double, usgs_lat double, "
        "kandilli_lon double, kandilli_lat double, usgs_place string, kandilli_place string, time_diff_seconds bigint, distance_km double, mag_diff double")
T0 = dt.datetime(2030, 5, 1, 23, 58)


def pair(i, j, km, day=0):
    t = T0 + dt.timedelta(days=day)
    return (f"u{i}", f"k{j}", t + dt.timedelta(seconds=i), t + dt.timedelta(seconds=j), 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, "p", "q", abs(i - j), float(km), 0.0)


def tables(spark):
    return (DayTable(spark, scratch_path(spark, "cands")), DayTable(spark, scratch_path(spark, "matches")))


def ids(df):
    return sorted((r.usgs_id, r.kandilli_id, r.distance_km) for r in df.collect())


def test_equals_the_batch_matcher_after_every_batch(spark):
    rng = random.Random(3)
    cands, matches = tables(spark)
    newest = {}
    for batch_id in range(4):
        rows = [pair(rng.randrange(150), rng.randrange(150), rng.randrange(1, 50)) for _ in range(40)]
        rows = list({r[:2]: r for r in rows}.values())  # later batches correct pairs of earlier ones
        newest |= {r[:2]: r for r in rows}
        for _ in range(1 + (batch_id == 2)):  # one batch is repeated
            J.update_matches(spark.createDataFrame(rows, PAIR), batch_id, cands, matches)
        want = ids(mutual_best(spark.createDataFrame(list(newest.values()), PAIR)))
        assert ids(matches.read()) == want and len(want) > 5
        assert cands.read().count() == len(newest)


def test_a_correction_frees_and_takes_partners(spark):
    cands, matches = tables(spark)
    J.update_matches(spark.createDataFrame([pair(1, 1, 5), pair(2, 2, 7)], PAIR), 0, cands, matches)
    J.update_matches(spark.createDataFrame([pair(2, 1, 3)], PAIR), 1, cands, matches)
    assert ids(matches.read()) == [("u2", "k1", 3.0)]  # k1 left u1, u2 left k2
    J.update_matches(spark.createDataFrame([pair(2, 1, 30)], PAIR), 2, cands, matches)
    assert ids(matches.read()) == [("u1", "k1", 5.0), ("u2", "k2", 7.0)]


def test_only_the_days_around_the_batch_are_read_and_written(spark, monkeypatch):
    cands, matches = tables(spark)
    for day in (0, 10, 20):
        J.update_matches(spark.createDataFrame([pair(1 + 1000 * day, 1 + 1000 * day, 5, day)], PAIR), day, cands, matches)
    read, real = [], DayTable.read
    monkeypatch.setattr(DayTable, "read", lambda self, version=None, days=None: read.append(days) or real(self, version, days))
    base = matches.version()
    J.update_matches(spark.createDataFrame([pair(20002, 20001, 1, 20)], PAIR), 21, cands, matches)
    monkeypatch.undo()
    assert read and all(d is not None and len(d) <= 4 for d in read)
    assert matches.read().count() == 3 and len(matches.changed_since(base)) == 1


def test_late_rows_go_to_the_side_and_come_back_by_a_replay(spark):
    landing, root, target = (scratch_path(spark, n) for n in ("landing", "routed", "hourly"))
    schema = "id bigint, at timestamp"
    at = lambda h, m=0: dt.datetime(2030, 5, 1, h, m)
    files = [[(1, at(1)), (2, at(1, 30))], [(3, at(4)), (4, at(1, 10))], [(5, at(1, 40)), (6, at(3, 30)), (7, at(6)), (8, None)], [(9, at(5, 30)), (10, at(2))]]
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    J.run_to_end(J.route_late(spark, src, "at", "1 hour", root))
    fields = spark.createDataFrame([], schema).schema
    late = J.late_rows(spark, root, fields)
    assert sorted((r.id, r.missed) for r in late.collect()) == [(5, at(3)), (8, at(3)), (10, at(5))]
    J.run_to_end(J.stream_hourly_counts(spark, J.on_time_rows(spark, root, fields, 1), "at", target, delay="1 hour"))
    counts = lambda: {r.hour_bucket.hour: r.event_count for r in spark.read.parquet(target).collect()}
    assert counts() == {1: 3, 3: 1, 4: 1, 5: 1, 6: 1}  # nothing on time was dropped by the watermark
    for _ in range(2):
        J.add_late_counts(spark, late, "at", target)
        assert counts() == {1: 4, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1}
    more = late.where("id < 0").union(spark.createDataFrame([(11, at(2, 5), at(5), 9)], late.schema))
    J.add_late_counts(spark, late.union(more), "at", target)
    assert counts()[2] == 2


def test_pairs_are_written_once_and_keep_their_columns(spark, monkeypatch):
    cands, matches = tables(spark)
    written, real = [], DayTable._write
    monkeypatch.setattr(DayTable, "_write", lambda self, rows, folder: written.append(self.root) or real(self, rows, folder))
    monkeypatch.setattr(J, "checkpointed", lambda df: (_ for _ in ()).throw(AssertionError("a copy of the pairs")))
    for batch_id, day in enumerate((0, 10, 11)):
        J.update_matches(spark.createDataFrame([pair(1 + day, 1 + day, 5, day), pair(2 + day, 1 + day, 3, day)], PAIR), batch_id, cands, matches)
    assert cands.root not in written  # new days are committed as staged
    names = [f.split()[0] for f in PAIR.split(", ")]
    assert cands.read().columns[:15] == names and matches.read().columns[:15] == names
    J.update_matches(spark.createDataFrame([pair(5, 1, 1)], PAIR), 3, cands, matches)
    assert written.count(cands.root) == 1 and cands.read().count() == 7
    assert ids(matches.read()) == [("u12", "k11", 3.0), ("u13", "k12", 3.0), ("u5", "k1", 1.0)]


def test_candidate_stream_keeps_what_is_within_the_delay_and_drops_old_buckets(spark):
    from conftest import EVENT_SCHEMA, events

    hour = lambda h, m, s=0: f"2030-05-01 {h:02d}:{m:02d}:{s:02d}"
    lands = {"u": [[("u1", hour(10, 0)), ("u2", hour(6, 0))], [("u3", hour(9, 1))], [("u4", hour(20, 0))]],
             "k": [[("k1", hour(10, 2)), ("k2", hour(6, 5))], [("k3", hour(9, 0, 1)), ("k4", hour(9, 2, 50))], [("k5", hour(20, 1))]]}
    sides = []
    for side, files in lands.items():
        path = scratch_path(spark, f"landing-{side}")
        for rows in files:
            events(spark, [(i, t, 4.0, 35.0, 25.0) for i, t in rows]).coalesce(1).write.mode("append").parquet(path)
        sides.append(spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path))
    out = scratch_path(spark, "pairs")
    q = J.land_candidates(spark, J.stream_candidates(*sides, delay="1 hour"), out)
    J.run_to_end(q)
    assert sorted(map(tuple, spark.read.parquet(out).select("usgs_id", "kandilli_id", "time_diff_seconds").collect())) == [
        ("u1", "k1", 120), ("u3", "k3", 59), ("u3", "k4", 110), ("u4", "k5", 60)]
    assert 0 < q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 10  # the newest bucket's rows and copies alone


def test_pairs_of_a_block_are_tested_cheaply_first(spark):
    from conftest import events

    side = events(spark, [("a", "2030-05-01 10:00:00", 4.0, 35.0, 25.0)])
    plan = J.stream_candidates(side, side)._jdf.queryExecution().optimizedPlan().toString()
    join = next(x for x in plan.splitlines() if "Join Inner" in x)
    assert "INTERVAL" not in join and "timestampdiff" not in join.lower()  # no calendar arithmetic for each pair
    assert join.index("unix_micros") < join.index("_mag#") < join.index("SIN(")
