"""Candidate pairs in packed form: the same pairs and matches, in rows that grow as the events."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import EVENT_SCHEMA, events
from seisma.operators import packs as P
from seisma.operators.matching import MatchConfig, match_candidates, mutual_best
from seisma.operators.snapshots import DayTable
from seisma.session import scratch_path
from seisma.streaming import jobs as J

BASE = dt.datetime(2030, 5, 1, 23, 30)


def dense(rnd, prefix, n):
    """Events of an hour around midnight: close ones, equal ones, some at the poles and across the antimeridian, some without magnitude."""
    rows = []
    for i in range(n):
        seconds = rnd.choice([rnd.uniform(0, 3600), rnd.randrange(0, 3600, 60)])
        lat = rnd.choice([rnd.uniform(-1, 1), rnd.choice([0.0, 0.1, 0.3]), rnd.choice([0.0, 0.1, 0.3]), rnd.choice([89.8, -89.8])])
        lon = rnd.choice([rnd.uniform(179, 180), -180.0, 179.9, 180.0, rnd.uniform(-180, -179)])
        mag = None if i % 13 == 0 else round(rnd.uniform(2, 4), 1)
        rows.append((f"{prefix}{rnd.choice('aé')}{i}", (BASE + dt.timedelta(seconds=seconds)).isoformat(sep=" "), mag, lon, lat))
    return rows


def test_packed_pairs_and_matches_equal_those_of_rows(spark, monkeypatch):
    rnd = random.Random(11)
    L, R = events(spark, dense(rnd, "u", 300)), events(spark, dense(rnd, "k", 400))
    for size, tested, cfg in ((1024, 1 << 17, MatchConfig()), (5, 40, MatchConfig()), (64, 300, MatchConfig(rank_digits=0, time_bucket_seconds=1000)), (9, 1, MatchConfig(max_km=900.0, lat_cell_deg=3.0))):
        monkeypatch.setattr(P, "PACK_ROWS", size)
        monkeypatch.setattr(P, "_TESTED", tested)
        monkeypatch.setattr(P, "_TAKEN", tested)
        want = match_candidates(L, R, cfg)
        packs = J.stream_candidates(L, R, cfg, packs=True)
        got = P.unpacked(packs, cfg)
        rows = sorted(map(repr, want.collect()))
        assert sorted(map(repr, got.collect())) == rows and len(rows) > 1000
        few = P.unpacked(packs, cfg, nearest=True)
        assert few.count() < len(rows)
        best = sorted(map(repr, mutual_best(few, cfg).collect()))
        assert best == sorted(map(repr, mutual_best(want, cfg).collect())) and len(best) > 50


def test_packed_rows_grow_as_the_events_of_a_block(spark):
    """All events in one block: 2,250,000 pairs, of which each event's nearest are left, in few rows before."""
    n = spark.range(1500)
    side = lambda p: n.select(
        F.concat(F.lit(p), F.col("id").cast("string")).alias("earthquake_id"),
        F.timestamp_seconds(F.lit(1_900_000_000) + F.col("id") % 100).alias("event_time"), F.lit(3.0).alias("mag"),
        (F.lit(35.0) + (F.col("id") % 7) / 100).alias("lon"), (F.lit(39.0) + (F.col("id") % 11) / 100).alias("lat"), F.lit("x").alias("place"))
    packs = J.stream_candidates(side("u"), side("k"), packs=True).localCheckpoint()
    assert packs.count() <= 16 and max(r[0] for r in packs.select(F.size("usgs_id")).collect()) <= P.PACK_ROWS
    assert P.unpacked(packs).count() == 1500 * 1500
    assert P.unpacked(packs, nearest=True).count() <= 16 * 1500


def test_stream_match_lands_every_candidate_packed(spark, monkeypatch):
    from conftest import SF_SMALL
    from seisma.plans import catalog

    landed, real = [], J.land_candidates
    monkeypatch.setattr(J, "land_candidates", lambda spark, cands, path, *a: landed.append(path) or real(spark, cands, path, *a))
    catalog.QUERIES["stream_match"](spark, SF_SMALL)
    got = P.unpacked(spark.read.parquet(landed[0]))
    key = ["usgs_id", "kandilli_id"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, catalog.QUERIES["match_candidates"](spark, SF_SMALL).select(*key).collect()))


def _landings(spark, rnd):
    """Both sides in four files; each takes up events of earlier files again, moved in place, time or magnitude, or as they were."""
    paths = {}
    for p in "uk":
        paths[p], known = scratch_path(spark, f"landing-{p}"), {}
        for k in range(4):
            rows = []
            for i in range(30):
                old = rnd.choice(list(known)) if known and rnd.random() < 0.4 else None
                name = old or f"{p}{k}-{i}"
                moved = (BASE + dt.timedelta(seconds=rnd.uniform(900, 2700))).isoformat(sep=" "), rnd.choice([2.0, 2.5]), 30 + rnd.choice([0.0, 0.1, rnd.uniform(0, 0.3)]), 40 + rnd.uniform(0, 0.2)
                row = known[name] if old and rnd.random() < 0.3 else (name, known[name][1] if old and rnd.random() < 0.7 else moved[0], *moved[1:])
                known[name] = row
                rows.append(row)
            rows += rows[:1] if k == 2 else []  # one event twice in a file
            events(spark, rows).coalesce(1).write.mode("append").parquet(paths[p])
    return [paths[p] for p in "uk"]


def test_corrections_of_packed_events_give_the_matches_of_corrected_pairs(spark, monkeypatch):
    monkeypatch.setattr(P, "PACK_ROWS", 4)
    paths, got, key = _landings(spark, random.Random(1)), {}, ["usgs_id", "kandilli_id"]
    for packs in (False, True):
        sides = [spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(p) for p in paths]
        stored, matches = (DayTable(spark, scratch_path(spark, n)) for n in ("cands", "matches"))
        J.run_to_end(J.stream_matches(spark, J.stream_candidates(*sides, delay="5 hours", packs=packs), stored, matches))
        got[packs] = sorted(map(repr, matches.read().collect()))
        if not packs:
            pairs = stored.read().drop("batch_id", "event_date")
            assert sorted(map(repr, matches.read().drop("event_date").collect())) == sorted(map(repr, mutual_best(pairs).collect()))
    assert got[True] == got[False] and len(got[True]) > 10
    assert matches.read().select("event_date").distinct().count() == 2  # the events lie around midnight
    every = P.unpacked(stored.read())
    assert every.count() > pairs.count() + 20  # so many pairs came again
    assert sorted(map(tuple, every.select(key).distinct().collect())) == sorted(map(tuple, pairs.select(key).collect()))


def test_packed_candidates_grow_as_the_events_and_a_repeated_batch_changes_nothing(spark):
    n = spark.range(400)
    side = lambda p: n.select(
        F.concat(F.lit(p), F.col("id").cast("string")).alias("earthquake_id"),
        F.timestamp_seconds(F.lit(1_900_000_000) + F.col("id") % 100).alias("event_time"), F.lit(3.0).alias("mag"),
        (F.lit(35.0) + F.col("id") / 10_000).alias("lon"), (F.lit(39.0) + (F.col("id") % 11) / 100).alias("lat"), F.lit("x").alias("place"))
    packs = J.stream_candidates(side("u"), side("k"), packs=True)
    stored, matches = (DayTable(spark, scratch_path(spark, n)) for n in ("cands", "matches"))
    for batch_id, first in ((0, True), (0, False), (1, False)):
        J.update_matches(packs.localCheckpoint(), batch_id, stored, matches)
        assert sorted(map(tuple, matches.read().select("usgs_id", "kandilli_id").collect())) == sorted((f"u{i}", f"k{i}") for i in range(400))
        rows = stored.read().count()
        assert rows <= 8 if batch_id == 0 else rows <= 16  # 160,000 pairs
    version = matches.version()
    assert J.update_matches(packs.where("false"), 2, stored, matches) == 0 and matches.version() == version
