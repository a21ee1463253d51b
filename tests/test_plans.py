"""Physical-plan properties the design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import events
from seisma.operators.dedup import dedup_latest
from seisma.operators.marts import daily_stats, top_n
from seisma.operators.matching import match_candidates, mutual_best


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    p = plan(dedup_latest(df, ["k"], [F.col("v").desc()]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_top_n_is_partial_before_single_partition(spark):
    p = plan(top_n(spark.range(1000), [F.col("id").desc()], 5))
    assert "TakeOrderedAndProject" in p or ("Partial" in p and "WindowGroupLimit" in p)


def test_aggregates_are_partial(spark):
    s = events(spark, [("u1", "2024-01-01 00:00:00", 1.0, 1.0, 1.0)])
    p = plan(daily_stats({"usgs": s.withColumn("source", F.lit("usgs"))}, dt.datetime(2024, 1, 2)))
    assert "partial_" in p


def test_matcher_is_an_equi_join_and_mutual_best_has_no_window(spark):
    L = events(spark, [("u1", "2024-01-01 00:00:00", 1.0, 1.0, 1.0)])
    c = match_candidates(L, L)
    p = plan(c)
    assert ("SortMergeJoin" in p or "HashJoin" in p) and "Cartesian" not in p and "NestedLoop" not in p
    assert "Window" not in plan(mutual_best(c)).split("Join")[0]


def test_day_writes_rebalance(spark):
    df = spark.range(10).select(F.lit("2024-01-01").cast("date").alias("event_date"), "id")
    lp = df.hint("rebalance", "event_date")._jdf.queryExecution().analyzed().toString()
    assert "RebalancePartitions" in lp
