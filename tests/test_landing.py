"""Landing zone: archive layout, NDJSON staging (FAILFAST, empty batch), baseline document."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from seisma.operators import cost as C
from seisma.operators.sinks import table_path
from seisma.session import scratch_path
from seisma.sources import landing as L
from seisma.sources.schemas import EMSC


def test_archive_layout_and_hash(spark):
    path = table_path(spark, "archive-test")
    docs = spark.createDataFrame([('{"a": 1}',), ('{"b": 2}',)], "doc string")
    L.archive_raw(docs, path, source="usgs", ingestion_time=dt.datetime(2024, 6, 7, 8, 9))
    local = path.replace("file:", "")
    assert os.path.isdir(f"{local}/source=usgs/year=2024/month=06/day=07/hour=08")
    back = L.read_archive(spark, path).collect()
    assert sorted(r.doc for r in back) == ['{"a": 1}', '{"b": 2}']
    assert {r.hour for r in back} == {"08"} and all(len(r.content_hash) == 8 for r in back)
    with pytest.raises(Exception):
        L.archive_raw(spark.createDataFrame([(None,)], "doc string"), path, source="usgs",
                      ingestion_time=dt.datetime(2024, 6, 7))


def test_ndjson_roundtrip_failfast_and_empty(spark):
    path = table_path(spark, "ndjson-test")
    rows = spark.createDataFrame(
        [("i1", dt.datetime(2024, 1, 1, 1), "e1", dt.datetime(2024, 1, 1, 0, 0, 0, 123456), None, 4.2)],
        "ingestion_id string, ingestion_time timestamp, event_id string, event_time timestamp, updated timestamp, "
        "mag double",
    )
    L.write_ndjson(rows, path)
    from pyspark.sql import Observation

    obs = Observation("load")
    loaded = L.load_ndjson(spark, path, EMSC.raw_schema, observation=obs)
    loaded.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 1
    back = L.load_ndjson(spark, path, EMSC.raw_schema).first()
    assert back.event_time == dt.datetime(2024, 1, 1, 0, 0, 0, 123456) and back.mag == 4.2
    with pytest.raises(ValueError):
        L.write_ndjson(rows.where(F.lit(False)), table_path(spark, "empty"))
    bad = table_path(spark, "bad-ndjson")
    spark.createDataFrame([('{"event_id": "x", "mag": "not a number"',)], "value string").write.text(bad)
    with pytest.raises(Exception):
        L.load_ndjson(spark, bad, EMSC.raw_schema).collect()


def test_baseline_document_roundtrip_and_missing(spark):
    path = table_path(spark, "baseline-test")
    assert C.read_baseline(spark, path).count() == 0  # missing file: every model is new
    b = spark.createDataFrame([("m1", 100, 1e-9), ("m2", 200, 2e-9)], "model string, bytes_processed bigint, "
                                                                        "shadow_cost_usd double")
    C.write_baseline(b, path)
    assert sorted(map(tuple, C.read_baseline(spark, path).collect())) == [("m1", 100, 1e-9), ("m2", 200, 2e-9)]
    pretty = table_path(spark, "baseline-pretty")  # the reference writes the map indented
    os.makedirs(pretty.replace("file:", ""))
    with open(pretty.replace("file:", "") + "/cost_baseline.json", "w") as f:
        json.dump({"m1": {"bytes_processed": 7, "shadow_cost_usd": 0.5}}, f, indent=2)
    assert [tuple(r) for r in C.read_baseline(spark, pretty).collect()] == [("m1", 7, 0.5)]


def test_read_docs_whole_files(spark):
    d = table_path(spark, "docs-test").replace("file:", "")
    os.makedirs(d)
    with open(d + "/a.json", "w") as f:
        json.dump({"type": "FeatureCollection", "features": [
            {"type": "Feature", "id": "x", "geometry": {"coordinates": [1, 2, 3]},
             "properties": {"time": 1719503100000}}]}, f, indent=2)
    from seisma.sources.feeds import parse_usgs, read_docs
    docs = read_docs(spark, d)
    assert docs.count() == 1 and docs.first().path.endswith("a.json")
    assert [(r.event_id, r.lat) for r in parse_usgs(docs).collect()] == [("x", 2.0)]


def test_cost_regression_statuses(spark):
    cur = spark.createDataFrame([("a", 121), ("b", 120), ("c", 5), ("d", None)], "model string, bytes_processed bigint")
    base = spark.createDataFrame([("a", 100), ("b", 100), ("d", 10)], "model string, bytes_processed bigint")
    rep = {r.model: r.status for r in C.cost_regression(cur, base).collect()}
    assert rep == {"a": "fail", "b": "pass", "c": "new", "d": "unknown"}  # 20 % is not a regression
    gate = C.regression_passed(C.cost_regression(cur, base)).first()
    assert (gate.passed, gate.models_checked, gate.models_failed) == (False, 4, 2)


def test_cost_gate_run_saves_baseline_only_on_pass(spark):
    cur = spark.createDataFrame([("a", 110), ("b", 50)], "model string, bytes_processed bigint")
    path = table_path(spark, "gate")
    assert C.run_cost_gate(spark, cur, path, check_only=True).first().passed is False  # empty baseline
    assert C.run_cost_gate(spark, cur, path).first().passed is True  # first run: all new, saved
    assert sorted(r.model for r in C.read_baseline(spark, path).collect()) == ["a", "b"]
    grown = spark.createDataFrame([("a", 200)], "model string, bytes_processed bigint")
    assert C.run_cost_gate(spark, grown, path).first().passed is False
    assert {r.model: r.bytes_processed for r in C.read_baseline(spark, path).collect()} == {"a": 110, "b": 50}
    ok = spark.createDataFrame([("a", 120)], "model string, bytes_processed bigint")
    assert C.run_cost_gate(spark, ok, path).first().passed is True
    assert {r.model: r.bytes_processed for r in C.read_baseline(spark, path).collect()} == {"a": 120, "b": 50}


COLLIDING = ("25302", "82945")  # equal in the first eight digits of their MD5


def archived(spark, path):
    return sorted(r.doc for r in L.read_archive(spark, path).collect())


def test_documents_that_share_a_short_hash_both_stay(spark):
    path, at = scratch_path(spark, "archive"), dt.datetime(2030, 5, 1, 10)
    docs = spark.createDataFrame([(d,) for d in COLLIDING], "doc string")
    for one in COLLIDING:
        L.archive_raw(docs.where(F.col("doc") == one), path, "s", at)
    assert archived(spark, path) == sorted(COLLIDING) and len({r.content_hash for r in L.read_archive(spark, path).collect()}) == 1
    L.archive_raw(docs, path, "s", at)  # a replay adds nothing
    assert archived(spark, path) == sorted(COLLIDING)
    L.archive_raw(docs, path, "s", at + dt.timedelta(hours=1))
    L.archive_raw(docs, path, "t", at)
    assert len(archived(spark, path)) == 6


def test_only_the_days_of_the_batch_are_looked_up(spark):
    path = scratch_path(spark, "archive")
    docs = spark.createDataFrame([(f"d{h}", dt.datetime(2030, 5, 1 + h // 24, h % 24)) for h in range(30)], "doc string, at timestamp")
    L.archive_raw(docs, path, "s", F.col("at"))
    plan = L.archived_digests(spark, path, [("s", "2030-05-02")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "2030-05-02" in text.split("PartitionFilters", 1)[1]
    assert plan.count() == 12 and {r.state for r in plan.collect()} == {"pending", "done"}


@pytest.mark.parametrize("dies", ["pending", "documents", "done"])
def test_archive_heals_after_a_crash(spark, monkeypatch, dies):
    path, at = scratch_path(spark, "archive"), dt.datetime(2030, 5, 1, 10)
    docs = spark.createDataFrame([("x",), ("y",)], "doc string")
    real, seen = L._note, []

    def note(digests, index, state):
        if dies == state:
            raise RuntimeError("killed")
        real(digests, index, state)
        if dies == "documents":
            raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(L, "_note", note)
        with pytest.raises(RuntimeError):
            L.archive_raw(docs, path, "s", at)
    assert L.archive_if_exists(spark, path) is None or archived(spark, path) == ["x", "y"]
    for _ in range(2):
        L.archive_raw(docs, path, "s", at)
        seen.append(archived(spark, path))
    assert seen == [["x", "y"]] * 2


def test_archive_without_an_index_is_looked_through(spark):
    path, at = scratch_path(spark, "archive"), dt.datetime(2030, 5, 1, 10)
    docs = spark.createDataFrame([("x",), ("y",)], "doc string")
    L.archive_raw(docs.where("doc = 'x'"), path, "s", at)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = scratch_path(spark, "old-archive")
    assert spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, spark._jvm.org.apache.hadoop.fs.Path(path), fs, spark._jvm.org.apache.hadoop.fs.Path(old), False, spark._jsc.hadoopConfiguration())
    L.archive_raw(docs, old, "s", at)
    assert archived(spark, old) == ["x", "y"]
    L.archive_raw(docs.limit(0), old, "s", at)
    assert archived(spark, old) == ["x", "y"]
