"""Session helpers and API edges."""

import datetime as dt

import pytest

from seisma.session import checkpoint_dir, ensure_utc, scratch_path
from seisma.sources.schemas import spec_for


def test_utc_and_shared_checkpoint_folder(spark):
    ensure_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    d = checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir")  # read from the session, never replaced
    assert scratch_path(spark, "x").startswith(d.rstrip("/") + "/x-")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_unknown_source_is_an_error(spark):
    with pytest.raises(ValueError):
        spec_for("nowhere")
    from seisma.plans.ingest import ingest_batch

    with pytest.raises(ValueError):
        ingest_batch(spark, spark.createDataFrame([("{}",)], "doc string"), "nowhere", "/tmp/unused", "id",
                     dt.datetime(2024, 1, 1))


def test_empty_ingest_reports_zero(spark):
    from seisma.operators.sinks import table_path
    from seisma.plans.ingest import ingest_batch

    empty = spark.createDataFrame([('{"type": "FeatureCollection", "features": []}',)], "doc string")
    r = ingest_batch(spark, empty, "usgs", table_path(spark, "never-written"), "b1", dt.datetime(2024, 1, 1)).first()
    assert (r.status, r.events_processed, r.rows_merged) == ("ok", 0, 0)
