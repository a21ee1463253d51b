"""Each contract with one passing and one failing input."""

import datetime as dt

from pyspark.sql import functions as F

from seisma.operators import contracts as K

AS_OF = dt.datetime(2024, 1, 31)


def rows(spark, data, schema="earthquake_id string, source string, mag double, event_time timestamp"):
    return spark.createDataFrame(data, schema)


def test_unique_not_null_accepted(spark):
    df = rows(spark, [("a", "usgs", 1.0, AS_OF), ("a", "usgs", 2.0, AS_OF), (None, "x", None, AS_OF),
                      (None, "usgs", 1.0, AS_OF)])
    assert [r.earthquake_id for r in K.expect_unique(df, "earthquake_id").collect()] == ["a"]
    assert K.expect_not_null(df, "mag").count() == 1
    bad = K.expect_accepted_values(df, "source", K.ACCEPTED_SOURCES).collect()
    assert [(r.source, r.n_records) for r in bad] == [("x", 1)]
    clean = df.where(F.col("earthquake_id") == "a").limit(1)
    assert K.expect_unique(clean, "earthquake_id").count() == 0


def test_event_freshness(spark):
    df = rows(spark, [("a", "usgs", 1.0, AS_OF - dt.timedelta(minutes=30))])
    assert K.event_freshness(df, "event_time", AS_OF, dt.timedelta(hours=24)).count() == 0
    late = K.event_freshness(df, "event_time", AS_OF + dt.timedelta(hours=3), dt.timedelta(hours=24)).first()
    assert late.minutes_since_last_event == 210
    empty = K.event_freshness(df, "event_time", AS_OF + dt.timedelta(days=3), dt.timedelta(hours=24)).first()
    assert empty.latest_event_time is None


def test_source_freshness_levels(spark):
    df = spark.createDataFrame([(AS_OF,)], "ingestion_time timestamp")
    warn, err = K.SOURCE_FRESHNESS["usgs"]
    got = [K.source_freshness(df, "ingestion_time", warn, err, AS_OF + dt.timedelta(minutes=m)).first().status
           for m in (10, 200, 300)]
    assert got == ["pass", "warn", "error"]


def test_min_events(spark):
    df = rows(spark, [("a", "usgs", 1.0, AS_OF - dt.timedelta(minutes=30)),
                      ("b", "usgs", 1.0, AS_OF - dt.timedelta(minutes=90))])
    assert K.min_events(df, "event_time", AS_OF).count() == 0
    one = K.min_events(df, "event_time", AS_OF + dt.timedelta(hours=5)).first()
    assert (one.hours_with_events, one.total_events) == (1, 1)
    none = K.min_events(df, "event_time", AS_OF + dt.timedelta(days=2)).first()
    assert (none.hours_with_events, none.total_events) == (0, 0)


def test_magnitude_range(spark):
    ok = rows(spark, [("a", "usgs", -2.0, AS_OF), ("b", "usgs", 10.0, AS_OF), ("c", "usgs", None, AS_OF)])
    bad = rows(spark, [("d", "kandilli", 10.1, AS_OF), ("e", "kandilli", -2.1, AS_OF - dt.timedelta(days=30))])
    assert K.magnitude_range([ok], AS_OF).count() == 0
    assert K.magnitude_range([ok, bad], AS_OF).first().invalid_count == 1


def test_cross_source_disagreement_top(spark):
    schema = "unified_id string, match_status string, usgs_mag double, kandilli_mag double, " \
             "mag_disagreement double, event_time timestamp"
    data = [(f"unified_{i}", "matched", 5.0, 5.0 - i / 10, i / 10, AS_OF) for i in range(30)]
    df = spark.createDataFrame(data, schema)
    out = K.cross_source_disagreement(df, AS_OF, threshold=0.5).orderBy("pos").collect()
    assert [r.pos for r in out] == [1, 2, 3, 4, 5]
    assert out[0].unified_id == "unified_29" and out[0].disagreement_count == 24
    assert K.cross_source_disagreement(df, AS_OF, threshold=9.0).count() == 0


def test_run_contracts_report(spark):
    df = rows(spark, [("a", "usgs", 1.0, AS_OF), ("a", "usgs", 1.0, AS_OF)])
    rep = {r.contract: r for r in K.run_contracts([
        K.Contract("uniq", K.expect_unique(df, "earthquake_id")),
        K.Contract("nn", K.expect_not_null(df, "mag")),
        K.Contract("warn", K.expect_unique(df, "earthquake_id"), severity="warn"),
    ]).collect()}
    assert (rep["uniq"].status, rep["nn"].status, rep["warn"].status) == ("fail", "pass", "warn")


def old_way(contracts):
    """Each contract's failing rows, counted on their own."""
    return sorted((c.name, c.severity, n, "pass" if not n else "warn" if c.severity == "warn" else "fail")
                  for c, n in ((c, c.failing.count()) for c in contracts))


def suite(df, as_of):
    return [
        K.unique("unique_id", df, "earthquake_id"), K.unique("unique_mag", df, "mag", "warn"), K.unique("unique_time", df, "event_time"),
        K.not_null("nn_id", df, "earthquake_id"), K.not_null("nn_mag", df, "mag", "warn"), K.not_null("nn_source", df, "source"),
        K.accepted_values("accepted", df, "source", K.ACCEPTED_SOURCES), K.accepted_values("accepted_warn", df, "source", ["usgs"], "warn"),
        K.row_rule("rule", df, F.col("mag") > 5), K.magnitudes_in_range("range", [df, df.limit(1)], as_of),
        K.fresh_events("fresh", df, "event_time", as_of, dt.timedelta(hours=24)),
        K.fresh_loads("loaded", df, "event_time", dt.timedelta(minutes=10), as_of, "warn"), K.enough_events("enough", df, "event_time", as_of)]


def test_counted_contracts_equal_their_failing_rows(spark):
    late = AS_OF - dt.timedelta(hours=5)
    data = [("a", "usgs", 1.0, AS_OF), ("a", "x", -0.0, late), (None, "x", 0.0, late), (None, None, None, None), ("b", "y", 11.0, AS_OF),
            ("c", "emsc", float("nan"), late), ("d", "emsc", float("nan"), None), ("", "", 4.0, late), ("", "", 4.0, late)]
    for held, as_of in ((data, AS_OF), (data, AS_OF + dt.timedelta(days=30)), (data[:0], AS_OF)):
        df = rows(spark, held)
        contracts = [*suite(df, as_of), K.Contract("plain", df.where("mag is null"), "warn")]
        report = K.run_contracts(contracts)
        assert sorted(tuple(r) for r in report.collect()) == old_way(contracts)
        assert report.columns == ["contract", "severity", "failing_rows", "status"]


def test_contracts_of_a_table_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, [("a", "usgs", 1.0, AS_OF)]).write.parquet(path)
    df = spark.read.parquet(path)
    contracts = [c for c in suite(df, AS_OF) if c.name != "range"]
    plan = K.run_contracts(contracts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    alone = K.run_contracts([K.Contract(c.name, c.failing) for c in contracts])._jdf.queryExecution().optimizedPlan().toString()
    assert alone.count("Relation [") == len(contracts)


def test_a_hot_value_is_counted_before_the_shuffle(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    report = K.run_contracts([K.unique("u", df, "k"), K.not_null("n", df, "k")])
    assert {r.contract: r.failing_rows for r in report.collect()} == {"u": 1, "n": 0}
    assert "partial_count" in report._jdf.queryExecution().executedPlan().toString()
