"""Means and sums over values of any size, NaN and NULL."""

import datetime as dt
import math

import pytest

from seisma.operators import marts

T0 = dt.datetime(2023, 3, 4, 5)


def mean_and_sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = df.agg(marts.exact_mean("v").alias("m"), marts.exact_sum("v").alias("s")).first()
    return row.m, row.s


@pytest.mark.parametrize("values", [[float("nan"), 2.0], [float("inf"), -float("inf"), 1.0]])
def test_nan_is_not_skipped(spark, values):
    assert all(math.isnan(x) for x in mean_and_sum(spark, values))


def test_values_of_any_size(spark):
    assert mean_and_sum(spark, [1e27, 1e27]) == (1e27, 2e27)
    assert mean_and_sum(spark, [-1e300, None]) == (-1e300, -1e300)
    assert mean_and_sum(spark, [float("inf"), 1.0]) == (math.inf, math.inf)
    assert mean_and_sum(spark, [None]) == (None, None)
    assert mean_and_sum(spark, []) == (None, None)


def test_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 4.4, 999999999.7] * 200
    assert mean_and_sum(spark, values) == mean_and_sum(spark, values[::-1])
    assert mean_and_sum(spark, [0.1] * 10)[1] == 1.0


def test_daily_stats_with_odd_magnitudes(spark):
    rows = [("a", T0, 1e27), ("b", T0, 1.0), ("c", T0 + dt.timedelta(days=1), float("nan")), ("d", T0 + dt.timedelta(days=1), 2.0),
            ("e", T0 + dt.timedelta(days=2), 1.25), ("e", T0 + dt.timedelta(days=2), 2.75), ("f", T0 + dt.timedelta(days=2), None)]
    df = spark.createDataFrame(rows, "earthquake_id string, event_time timestamp, mag double")
    got = {r.event_date.day: (r.earthquake_count, r.avg_magnitude) for r in marts.daily_stats({"usgs": df}, T0).collect()}
    assert got[4] == (2, 5e26) and got[6] == (1, 2.0)
    assert got[5][0] == 2 and math.isnan(got[5][1])
