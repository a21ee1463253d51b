"""Stored merge, archive, baseline and parsers under odd rows, crashes and replays."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seisma.functions.hashing import document_hash
from seisma.functions.times import parse_iso_utc, parse_local_ts
from seisma.operators import cost
from seisma.operators.marts import daily_stats
from seisma.operators.sinks import write_days
from seisma.operators.upsert import merge_into_days
from seisma.plans.ingest import ingest_batch
from seisma.session import checkpoint_dir, read_if_exists, scratch_path
from seisma.sources.feeds import parse_emsc, parse_kandilli, parse_usgs, unreadable
from seisma.sources.landing import archive_raw, read_archive
from seisma.sources.schemas import SPECS


def raw(spark, spec, rows):
    """Raw rows (key, time, version) of a feed; other columns NULL, raw_json names the row."""
    made = spark.createDataFrame([(*r, f"{r[0]}@{r[2]}") for r in rows], "k string, t timestamp, v timestamp, j string")
    value = {spec.key: "k", spec.time_col: "t", spec.version: "v", "raw_json": "j"}
    return made.select(*[(F.col(value[c]) if c in value else F.lit(None)).cast(t).alias(c) for c, t in spec.raw_columns])


def stored(spark, path, spec):
    return sorted(((r[spec.key], r[spec.time_col], r[spec.version]) for r in spark.read.parquet(path).collect()), key=str)


def day(n, h=0):
    return dt.datetime(2030, 5, n, h)


@pytest.mark.parametrize("feed", ["usgs", "emsc", "kandilli"])
def test_merge_keeps_null_days_and_quarantines(spark, feed):
    spec, path = SPECS[feed], scratch_path(spark, "merge")
    first = raw(spark, spec, [("a", None, day(1)), ("b", None, day(1)), ("c", day(2), day(2)), ("d", day(3), day(3))])
    write_days(first.withColumn("event_date", F.to_date(spec.time_col)), path, "event_date", cluster_by=None, overwrite_all=True)
    bad = [("z", None, day(9)), (None, day(9), day(9)), ("", day(9), day(9))]
    batch = raw(spark, spec, [*bad, ("e", day(2), day(4)), ("a", day(7), day(8)), ("d", day(6), day(5))])
    counts = merge_into_days(spark, path, batch, spec).first()
    want = [("a", day(7), day(8)), ("b", None, day(1)), ("c", day(2), day(2)), ("d", day(6), day(5)), ("e", day(2), day(4))]
    assert stored(spark, path, spec) == sorted(want, key=str)
    assert (counts.rows_inserted, counts.rows_updated) == (1, 2)
    assert merge_into_days(spark, path, batch, spec).first().rows_affected == 0  # a replay changes nothing
    assert stored(spark, path, spec) == sorted(want, key=str) and spark.read.parquet(f"{path}_rejected").count() == 3


def test_merge_heals_after_a_crash_between_overwrite_and_clearing(spark):
    spec, path = SPECS["usgs"], scratch_path(spark, "crash")
    two = raw(spark, spec, [("a", day(1), day(1)), ("a", day(5), day(5)), ("b", day(1), day(1))])  # the key stands in two days
    write_days(two.withColumn("event_date", F.to_date(spec.time_col)), path, "event_date", cluster_by=None, overwrite_all=True)
    merge_into_days(spark, path, raw(spark, spec, [("a", day(5), day(5))]), spec)
    assert stored(spark, path, spec) == [("a", day(5), day(5)), ("b", day(1), day(1))]


def test_iso_forms(spark):
    forms = {
        "2024-06-27": (0, 0, 0, 0), "2024-06-27T18:45Z": (18, 45, 0, 0), "2024-06-27 18:45": (18, 45, 0, 0),
        "2024-06-27T18:45:00+0300": (15, 45, 0, 0), "20240627T184500Z": (18, 45, 0, 0), "2024-06-27T18:45:00.1234567Z": (18, 45, 0, 123456),
        "2024-06-27T18:45:00-05:30": (24, 15, 0, 0), "2024-06-27T18": (18, 0, 0, 0)}
    df = spark.createDataFrame([(k,) for k in [*forms, "2024-13-01", "2024-06-27Tx", "", None]], "s string")
    got = {r.s: (r.u, r.l) for r in df.select("s", parse_iso_utc("s").alias("u"), parse_local_ts("s", "Europe/Istanbul").alias("l")).collect()}
    for text, (h, m, s, us) in forms.items():
        instant = dt.datetime(2024, 6, 27) + dt.timedelta(hours=h, minutes=m, seconds=s, microseconds=us)
        naive = dt.datetime.fromisoformat(text).tzinfo is None
        assert got[text] == (instant, instant - dt.timedelta(hours=3 if naive else 0)), text
    assert all(got[t] == (None, None) for t in ("2024-13-01", "2024-06-27Tx", "", None))


def test_numbers_as_text_and_unreadable_documents(spark):
    feature = {"id": "n1", "geometry": {"coordinates": ["10.5", 20, None]}, "properties": {"mag": "4.5", "time": 1583020799000.0, "nst": "12.0", "sig": 7.5}}
    docs = spark.createDataFrame([(json.dumps({"features": [feature]}),)], "doc string")
    r = parse_usgs(docs).first()
    assert (r.mag, r.lon, r.lat, r.depth_km, r.nst, r.sig) == (4.5, 10.5, 20.0, None, 12, None)
    assert r.event_time == dt.datetime(2020, 2, 29, 23, 59, 59)
    item = {"earthquake_id": 5, "date_time": "2022-01-15 02:30:00", "mag": "2.25", "geojson": {"coordinates": [1, "2.5", 3]}}
    k = parse_kandilli(spark.createDataFrame([(json.dumps({"status": True, "result": [item]}),)], "doc string")).first()
    assert (k.event_id, k.mag, k.lon, k.lat, k.depth_km) == ("5", 2.25, 1.0, 2.5, 3.0)
    broken = docs.union(spark.createDataFrame([("<html>502</html>",), ('{"features": [{"id"',)], "doc string"))
    for parse in (parse_usgs, parse_emsc):
        with pytest.raises(PySparkException):
            parse(broken).collect()
    assert parse_usgs(broken, strict=False).count() == 1 and unreadable(broken).count() == 2


def test_ingest_order_archive_and_hash(spark):
    spec, path, archive = SPECS["usgs"], scratch_path(spark, "target"), scratch_path(spark, "archive")
    write_days(raw(spark, spec, [("a", day(1), day(1))]).withColumn("event_date", F.to_date(spec.time_col)), path, "event_date", cluster_by=None, overwrite_all=True)
    none = spark.createDataFrame([(json.dumps({"features": []}),)], "doc string")
    assert tuple(ingest_batch(spark, none, "usgs", path, "i0", day(1), archive).first()) == ("ok", "usgs", "i0", 0, 0)
    with pytest.raises(PySparkException):
        ingest_batch(spark, spark.createDataFrame([("<html>",)], "doc string"), "usgs", path, "i1", day(1), archive)
    with pytest.raises(PySparkException):  # nothing was archived
        read_archive(spark, archive).collect()
    one = {"features": [{"id": "n", "geometry": None, "properties": {"time": 1583020799000, "updated": 1583020799000, "mag": 1}}]}
    docs = spark.createDataFrame([(json.dumps(one),)], "doc string")
    for _ in range(2):
        assert ingest_batch(spark, docs, "usgs", path, "i2", day(2), archive).first().status == "ok"
    assert read_archive(spark, archive).count() == 1
    archive_raw(docs, archive, source="usgs", ingestion_time=day(3))
    assert read_archive(spark, archive).count() == 2
    texts = spark.createDataFrame([('{"a": 1, "b": {"d": 2, "c": [1]}}',), ('{"b":{"c":[1],"d":2},"a":1}',), ("no json",)], "d string")
    a, b, c = [r[0] for r in texts.select(document_hash("d")).collect()]
    assert a == b != c


def test_damaged_baseline_and_table_raise(spark, tmp_path):
    path = tmp_path / "baseline"
    path.mkdir()
    (path / "part-0").write_text('{"m1": {"bytes_processed": 100, "shadow_cost_usd": 0.1}, "m2": {"bytes_pro')
    current = spark.createDataFrame([("m1", 100), ("m2", 900)], "model string, bytes_processed bigint")
    with pytest.raises(Exception, match="(?i)malformed|JsonEOF|parse"):
        cost.run_cost_gate(spark, current, str(path)).collect()
    assert (path / "part-0").read_text().endswith('{"bytes_pro')
    (tmp_path / "table").mkdir()
    (tmp_path / "table" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_if_exists(spark, str(tmp_path / "table"))
    assert read_if_exists(spark, str(tmp_path / "none")) is None


def test_checkpoint_folder_is_required_on_a_cluster(spark):
    class Fake:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

        class conf:  # noqa: N801
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(RuntimeError):
        checkpoint_dir(Fake)


def test_means_keep_small_digits(spark):
    df = spark.createDataFrame([("e1", day(1), 2.67499)], "earthquake_id string, event_time timestamp, mag double")
    r = daily_stats({"usgs": df}, day(2)).first()
    assert r.avg_magnitude == 2.67
