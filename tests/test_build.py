"""A model build run twice: the second run refreshes only the last days of the daily mart."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from seisma.operators.contracts import ContractError
from seisma.operators.cost import model_cost
from seisma.operators.marts import daily_stats
from seisma.operators.sinks import table_path
from seisma.plans import models
from seisma.sources import testdata
from seisma.sources.testdata import AS_OF


def test_build_twice_equals_full_daily(spark):
    raw = testdata.raw_feeds(spark, SF_SMALL)
    root = table_path(spark, "build-test")
    models.build_models(spark, raw, root, AS_OF, stop_on_error=False)
    paths = models.build_models(spark, raw, root, AS_OF + dt.timedelta(hours=1), stop_on_error=False)
    got = spark.read.parquet(paths["dm_daily"]).drop("processed_at")
    exp = daily_stats(models.staged(raw), AS_OF).drop("processed_at")
    key = lambda r: (str(r.event_date), r.source)
    assert sorted(got.select(*exp.columns).collect(), key=key) == sorted(exp.collect(), key=key)
    rep = {r.contract: r.status for r in spark.read.parquet(paths["contract_report"]).collect()}
    assert rep["unique_unified_id"] == "pass" and rep["accepted_match_status"] == "pass"


def test_build_stores_costs_and_failures_and_stops(spark):
    raw = testdata.raw_feeds(spark, SF_SMALL)
    jobs = testdata.job_log(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    root = table_path(spark, "build-costs")
    paths = models.build_models(spark, raw, root, AS_OF, job_log=jobs, stop_on_error=False)
    fact, day = spark.read.parquet(paths["fct_model_cost"]), spark.read.parquet(paths["dm_daily_cost"])
    assert fact.count() == model_cost(jobs, AS_OF).count() > 0
    assert day.agg(F.sum("total_jobs")).first()[0] == fact.count()
    more = {r.contract: r.status for r in spark.read.parquet(paths["contract_report_more"]).collect()}
    assert more["unique_match_id"] == more["accepted_source_usgs"] == more["not_null_cost_run_date"] == "pass"
    failing = [r.contract for p in ("contract_report", "contract_report_more") for r in spark.read.parquet(paths[p]).collect() if r.failing_rows]
    for name in failing:
        assert spark.read.parquet(f"{root}/failures/{name}").count() > 0
    bad = dict(raw, usgs=raw["usgs"].withColumn("event_time", F.lit(None).cast("timestamp")))
    with pytest.raises(ContractError, match="not_null_time_usgs"):
        models.build_models(spark, bad, table_path(spark, "build-bad"), AS_OF)
