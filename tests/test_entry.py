"""Driver contract: entry() smoke run and oracle parity of registered queries at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from seisma.plans import catalog
from seisma.sources.testdata import TABLES

# Queries with side effects (writes, streams) are covered by scripts/check_oracle.py at sf0.01.
FAST = ["dedup_latest", "dedup_latest_lineitem", "stg_project_kandilli", "match_candidates", "mutual_best",
        "reconcile_matches", "recent_window", "unify_events", "daily_stats", "hourly_counts", "source_24h_stats",
        "recent_daily_top10", "freshness_usgs_late", "source_freshness", "min_events_late", "count_sum_having",
        "range_invalid", "magnitude_range", "cross_source_disagreement", "top5_struct_agg", "expect_unique",
        "expect_not_null", "contract_report", "model_cost", "daily_cost", "cost_totals", "cost_regression",
        "baseline_update", "merge_usgs", "merge_kandilli", "merge_affected", "content_hash", "to_raw_usgs"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 902 and df.columns[0] == "match_status"


def test_every_query_has_oracle_or_is_documented():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(catalog.QUERIES) - set(o) == set()


@pytest.mark.parametrize("name", FAST)
def test_oracle_parity(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    rel = duck.sql(E.oracle_sql()[name])
    ocols = rel.columns
    assert sorted(cols) == sorted(ocols)
    idx = {c: i for i, c in enumerate(ocols)}
    exp = sorted((tuple(norm(r[idx[c]]) for c in sorted(ocols)) for r in rel.fetchall()), key=repr)
    assert got == exp
