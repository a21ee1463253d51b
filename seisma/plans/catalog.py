"""Registered queries: one per operator of the inventory, over the driver tables.

Each query is ``fn(spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the
equivalent DuckDB SQL (see ``seisma.plans.oracle``) where one exists.
Outputs are shaped for comparison: UTC instants as wall-clock
``TIMESTAMP_NTZ`` (the naive timestamps the oracle holds), trig results
rounded to 6 digits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from seisma.functions import geo, times
from seisma.functions.hashing import content_hash, staging_name
from seisma.operators import contracts as K
from seisma.operators import cost as C
from seisma.operators import marts as M
from seisma.operators import matching
from seisma.operators import sinks
from seisma.operators import upsert as U
from seisma.operators.dedup import dedup_latest
from seisma.operators.packs import unpacked
from seisma.operators.snapshots import DayTable
from seisma.operators.staging import stg_project
from seisma.operators.unify import unify_events
from seisma.plans import models
from seisma.plans import oracle as O
from seisma.plans.ingest import ingest_batch
from seisma.session import checkpointed
from seisma.sources import documents as D
from seisma.sources import feeds as FD
from seisma.sources import landing as L
from seisma.sources import testdata
from seisma.sources.schemas import SPECS
from seisma.sources.testdata import AS_OF
from seisma.streaming import jobs as J

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def naive_ts(df: DataFrame) -> DataFrame:
    """UTC ``TIMESTAMP`` columns as wall-clock ``TIMESTAMP_NTZ`` (comparison shape)."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _stg(spark, sf):
    return models.test_stg(spark, sf)


def _matches(spark, sf, as_of=None):
    return models.matches(_stg(spark, sf), matching.DEFAULT, as_of)


# --- 2.E / 2.C staging --------------------------------------------------------------------

@register("dedup_latest", f"""{O.FEEDS}
SELECT source, event_id, event_time, updated, ingestion_time, mag, version FROM stg""")
def q_dedup_latest(spark, sf):
    q = testdata.quake_raw(testdata.table(spark, sf, "events"))
    q = testdata.with_feed_columns(q)
    out = dedup_latest(q, ["source", "event_id"], [
        F.col("ingestion_time").desc_nulls_last(), F.col("updated").desc_nulls_last(),
        F.col("ingestion_id").desc_nulls_last(), F.col("raw_json").asc_nulls_last()])
    return naive_ts(out.select("source", "event_id", "event_time", "updated", "ingestion_time", "mag", "version"))


@register("dedup_latest_lineitem", """
SELECT * EXCLUDE (rn) FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey
                            ORDER BY l_shipdate DESC NULLS LAST, l_linenumber, l_partkey, l_suppkey) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup_lineitem(spark, sf):
    li = testdata.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    return dedup_latest(li, ["l_orderkey"], [F.col("l_shipdate").desc_nulls_last(), F.col("l_linenumber").asc(),
                                             F.col("l_partkey").asc(), F.col("l_suppkey").asc()])


_SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "timestamp": "TIMESTAMP"}


def _raw_column_sql(src: str) -> dict[str, str]:
    """DuckDB expression of each raw column of a feed over ``quake_raw`` (typed NULL when absent)."""
    spec = SPECS[src]
    known = {
        "ingestion_id": "'ing-' || CAST(version AS VARCHAR)", "ingestion_time": "ingestion_time",
        spec.key: "event_id", spec.time_col: "event_time", spec.version: "updated", "mag": "mag",
        "place": "place", "title": "place", "lon": "lon", "lat": "lat", "depth_km": "depth_km",
        "raw_json": "event_id || '#' || CAST(version AS VARCHAR)",
    }
    return {c: known.get(c, f"CAST(NULL AS {_SQL_TYPES[t]})") for c, t in spec.raw_columns}


def _stg_project_sql(src: str) -> str:
    raw = _raw_column_sql(src)
    cols = [f"'{src}' AS source" if out == "source" else f"{raw[rawc]} AS {out}"
            for out, rawc in SPECS[src].stg_columns()]
    return f"WITH {O.QUAKE_BASE},{O.QUAKE_RAW}\nSELECT {', '.join(cols)} FROM quake_raw WHERE source = '{src}'"


def _make_stg_project(src: str):
    def q(spark, sf):
        raw = testdata.raw_feed(testdata.quake_raw(testdata.table(spark, sf, "events")), src)
        return naive_ts(stg_project(raw, SPECS[src]))

    return q


for _src in ("usgs", "emsc", "kandilli"):
    register(f"stg_project_{_src}", _stg_project_sql(_src))(_make_stg_project(_src))


# --- 2.D / 2.E / 2.F matcher ---------------------------------------------------------------

_CAND_COLS = ("usgs_id, kandilli_id, usgs_time, kandilli_time, usgs_mag, kandilli_mag, usgs_lon, usgs_lat, "
              "kandilli_lon, kandilli_lat, usgs_place, kandilli_place, time_diff_seconds, "
              "round(distance_km, 6) AS distance_km, mag_diff")


@register("match_candidates", f"""{O.FEEDS},{O.matcher_ctes()}
SELECT {_CAND_COLS} FROM near""")
def q_match_candidates(spark, sf):
    s = _stg(spark, sf)
    c = matching.match_candidates(s["usgs"], s["kandilli"])
    return naive_ts(c.withColumn("distance_km", F.round("distance_km", 6)))


@register("mutual_best", f"""{O.FEEDS},{O.matcher_ctes()}
SELECT {_CAND_COLS} FROM couple""")
def q_mutual_best(spark, sf):
    s = _stg(spark, sf)
    b = matching.mutual_best(matching.match_candidates(s["usgs"], s["kandilli"]))
    return naive_ts(b.withColumn("distance_km", F.round("distance_km", 6)))


def _status(name: str, status: str):
    @register(name, f"""{O.FEEDS},{O.matcher_ctes()}
{O.MATCH_SELECT} WHERE match_status = '{status}'""")
    def q(spark, sf):
        m = _matches(spark, sf)
        return naive_ts(m.where(F.col("match_status") == status).withColumn("distance_km", F.round("distance_km", 6)))

    return q


_status("usgs_only", "usgs_only")
_status("kandilli_only", "kandilli_only")


@register("reconcile_matches", f"""{O.FEEDS},{O.matcher_ctes()}
{O.MATCH_SELECT}""")
def q_reconcile(spark, sf):
    return naive_ts(_matches(spark, sf).withColumn("distance_km", F.round("distance_km", 6)))


@register("recent_window", f"""{O.FEEDS},{O.matcher_ctes('7 DAY')}
{O.MATCH_SELECT}""")
def q_recent_window(spark, sf):
    return naive_ts(_matches(spark, sf, AS_OF).withColumn("distance_km", F.round("distance_km", 6)))


@register("unify_events", f"""{O.FEEDS},{O.matcher_ctes()},{O.UNIFIED_CTE}
SELECT * FROM unified""")
def q_unify_events(spark, sf):
    return naive_ts(unify_events(_matches(spark, sf), AS_OF))


@register("unify_events_recent", f"""{O.FEEDS},{O.matcher_ctes('7 DAY')},{O.UNIFIED_CTE}
SELECT * FROM unified""")
def q_unify_recent(spark, sf):
    return naive_ts(unify_events(_matches(spark, sf, AS_OF), AS_OF))


# --- 2.G / 2.H marts ------------------------------------------------------------------------


_LATE = dt.timedelta(hours=5, minutes=30)


def _raw(spark, sf):
    return testdata.raw_feeds(spark, sf)


@register("daily_stats", f"""{O.FEEDS}
{O.daily_sql('stg')}""")
def q_daily_stats(spark, sf):
    return naive_ts(M.daily_stats(_stg(spark, sf), AS_OF))


@register("union_sources", f"""{O.FEEDS}
SELECT CAST(event_time AS DATE) AS event_date, source, mag AS magnitude, event_id FROM stg""")
def q_union_sources(spark, sf):
    return M.source_rows(_stg(spark, sf))


@register("insert_overwrite_days", f"""{O.FEEDS}
SELECT * FROM ({O.daily_sql('quake_base', "AND CAST(event_time AS DATE) < DATE '2024-01-28'")})
UNION ALL
SELECT * FROM ({O.daily_sql('stg', "AND CAST(event_time AS DATE) >= DATE '2024-01-28'")})""")
def q_insert_overwrite_days(spark, sf):
    """Full build from a stale state, then an incremental refresh of the last 3 days."""
    ev = testdata.table(spark, sf, "events")
    stale = models.staged({s: testdata.raw_feed(testdata.quake_base(ev), s) for s in SPECS})
    path = sinks.table_path(spark, "dm_earthquake_daily")
    sinks.write_days(M.daily_stats(stale, AS_OF), path, "event_date", overwrite_all=True)
    since = AS_OF.date() - dt.timedelta(days=3)
    sinks.write_days(M.daily_stats(_stg(spark, sf), AS_OF, since=since), path, "event_date")
    return naive_ts(sinks.read_days(spark, path, "event_date"))


@register("hourly_counts", f"""{O.FEEDS}
SELECT date_trunc('hour', event_time) AS hour_bucket, count(*) AS event_count FROM quake_raw
WHERE source = 'usgs' GROUP BY 1""")
def q_hourly_counts(spark, sf):
    return naive_ts(M.hourly_counts(_raw(spark, sf)["usgs"], "event_time"))


_SRC24 = " UNION ALL ".join(
    f"""SELECT '{label}' AS source, count(*) AS event_count,
       round(favg(mag), 2) AS avg_mag
FROM quake_raw WHERE source = '{src}' AND event_time >= {O.AS_OF_SQL} - INTERVAL 24 HOUR"""
    for label, src in (("USGS", "usgs"), ("EMSC", "emsc"), ("Kandilli", "kandilli")))


@register("source_24h_stats", f"""{O.FEEDS}
{_SRC24}""")
def q_source_24h(spark, sf):
    r = _raw(spark, sf)
    return M.source_stats([("USGS", r["usgs"], "event_time"), ("EMSC", r["emsc"], "event_time"),
                           ("Kandilli", r["kandilli"], "date_time")], AS_OF)


@register("recent_daily_top10", f"""{O.FEEDS}
SELECT event_date, source, earthquake_count, avg_magnitude, max_magnitude FROM ({O.daily_sql('stg')})
WHERE earthquake_count > 0 ORDER BY event_date DESC, source LIMIT 10""")
def q_recent_top10(spark, sf):
    return M.recent_daily_top(M.daily_stats(_stg(spark, sf), AS_OF), 10)


@register("max_event_time", f"""{O.FEEDS}
SELECT max(event_time) AS latest_event_time FROM quake_raw
WHERE source = 'usgs' AND event_time >= {O.AS_OF_SQL} - INTERVAL 24 HOUR""")
def q_max_event_time(spark, sf):
    return naive_ts(M.max_event_time(_raw(spark, sf)["usgs"], "event_time", AS_OF, dt.timedelta(hours=24)))


# --- 2.K contracts ----------------------------------------------------------------------------

def _fresh_sql(src: str, col_hours: int, as_of: str, name: str) -> str:
    return f"""{O.FEEDS}
SELECT '{name}' AS test_name, newest AS latest_event_time, date_sub('minute', newest, {as_of}) AS minutes_since_last_event
FROM (SELECT max(event_time) FILTER (event_time >= {as_of} - INTERVAL {col_hours} HOUR) AS newest FROM quake_raw WHERE source = '{src}')
WHERE coalesce(newest < {as_of} - INTERVAL 2 HOUR, true)"""


_LATE_SQL = f"({O.AS_OF_SQL} + INTERVAL 330 MINUTE)"

for _src, _hours, _col in (("usgs", 24, "event_time"), ("kandilli", 48, "date_time")):
    for _suffix, _asof_sql, _delta in (("", O.AS_OF_SQL, dt.timedelta(0)), ("_late", _LATE_SQL, _LATE)):
        _name = f"{'USGS' if _src == 'usgs' else 'Kandilli'} freshness check"

        def _q(spark, sf, _src=_src, _hours=_hours, _col=_col, _delta=_delta, _name=_name):
            return naive_ts(K.event_freshness(_raw(spark, sf)[_src], _col, AS_OF + _delta,
                                              dt.timedelta(hours=_hours), name=_name))

        register(f"freshness_{_src}{_suffix}", _fresh_sql(_src, _hours, _asof_sql, _name))(_q)


_FRESH_AT = f"({O.AS_OF_SQL} + INTERVAL 4 HOUR)"
_SRCFRESH = " UNION ALL ".join(
    f"""SELECT '{s}' AS source, max(ingestion_time) AS max_loaded_at,
       CAST(epoch_us({_FRESH_AT}) - epoch_us(max(ingestion_time)) AS DOUBLE) / 1e6 AS age_seconds,
       CASE WHEN max(ingestion_time) IS NULL
                 OR CAST(epoch_us({_FRESH_AT}) - epoch_us(max(ingestion_time)) AS DOUBLE) / 1e6 > {e} THEN 'error'
            WHEN CAST(epoch_us({_FRESH_AT}) - epoch_us(max(ingestion_time)) AS DOUBLE) / 1e6 > {w} THEN 'warn'
            ELSE 'pass' END AS status
FROM quake_raw WHERE source = '{s}'"""
    for s, (w, e) in ((s, tuple(int(x.total_seconds()) for x in K.SOURCE_FRESHNESS[s])) for s in ("usgs", "emsc", "kandilli")))


@register("source_freshness", f"""{O.FEEDS}
{_SRCFRESH}""")
def q_source_freshness(spark, sf):
    """Load age per feed four hours after the data ends: usgs/kandilli warn, emsc passes."""
    r = _raw(spark, sf)
    out = None
    for s in ("usgs", "emsc", "kandilli"):
        warn, err = K.SOURCE_FRESHNESS[s]
        part = K.source_freshness(r[s], "ingestion_time", warn, err, AS_OF + dt.timedelta(hours=4), s)
        out = part if out is None else out.unionByName(part)
    return naive_ts(out)


def _min_events_sql(as_of: str) -> str:
    return f"""{O.FEEDS}
SELECT 'Min events check' AS test_name, * FROM (
  SELECT count(DISTINCT date_trunc('hour', event_time)) AS hours_with_events, count(*) AS total_events
  FROM quake_raw WHERE source = 'usgs' AND event_time >= {as_of} - INTERVAL 6 HOUR)
WHERE hours_with_events < 2"""


@register("min_events", _min_events_sql(O.AS_OF_SQL))
def q_min_events(spark, sf):
    return K.min_events(_raw(spark, sf)["usgs"], "event_time", AS_OF)


@register("min_events_late", _min_events_sql(_LATE_SQL))
def q_min_events_late(spark, sf):
    return K.min_events(_raw(spark, sf)["usgs"], "event_time", AS_OF + _LATE)


@register("count_sum_having", _min_events_sql(f"({O.AS_OF_SQL} + INTERVAL 30 DAY)"))
def q_count_sum_having(spark, sf):
    """Global COUNT / COALESCE(SUM) + HAVING over an empty window: still one row."""
    return K.min_events(_raw(spark, sf)["usgs"], "event_time", AS_OF + dt.timedelta(days=30))


_BAD_STG = f"""{O.FEEDS},
bad AS (
  SELECT event_id AS earthquake_id, source,
         CASE WHEN n % 49 = 0 THEN mag * 4 WHEN n % 50 = 0 THEN mag - 3 ELSE mag END AS mag, event_time
  FROM stg WHERE source IN ('usgs', 'kandilli')
)"""


def _bad_stg(spark, sf):
    s = _stg(spark, sf)
    out = []
    for name in ("usgs", "kandilli"):
        n = F.regexp_extract(F.col("earthquake_id"), r"([0-9]+)$", 1).cast("bigint")
        out.append(s[name].withColumn(
            "mag", F.when(n % 49 == 0, F.col("mag") * 4).when(n % 50 == 0, F.col("mag") - 3).otherwise(F.col("mag"))))
    return out


@register("range_invalid", f"""{_BAD_STG}
SELECT earthquake_id, source, mag, event_time FROM bad WHERE mag IS NOT NULL AND (mag < -2 OR mag > 10)""")
def q_range_invalid(spark, sf):
    return naive_ts(K.union_invalid(_bad_stg(spark, sf)))


@register("magnitude_range", f"""{_BAD_STG}
SELECT 'Magnitude range check' AS test_name, count(*) AS invalid_count FROM bad
WHERE mag IS NOT NULL AND (mag < -2 OR mag > 10) AND event_time >= {O.AS_OF_SQL} - INTERVAL 7 DAY
HAVING count(*) > 0""")
def q_magnitude_range(spark, sf):
    return K.magnitude_range(_bad_stg(spark, sf), AS_OF)


@register("magnitude_range_clean", f"""{O.FEEDS}
SELECT 'Magnitude range check' AS test_name, count(*) AS invalid_count FROM stg
WHERE source IN ('usgs', 'kandilli') AND mag IS NOT NULL AND (mag < -2 OR mag > 10)
  AND event_time >= {O.AS_OF_SQL} - INTERVAL 7 DAY HAVING count(*) > 0""")
def q_magnitude_range_clean(spark, sf):
    s = _stg(spark, sf)
    return K.magnitude_range([s["usgs"], s["kandilli"]], AS_OF)


_DISAGREE = f"""{O.FEEDS},{O.matcher_ctes()},{O.UNIFIED_CTE},
dis AS (SELECT * FROM unified WHERE match_status = 'matched' AND mag_disagreement > 0.5
        AND event_time >= {O.AS_OF_SQL} - INTERVAL 7 DAY),
top AS (SELECT unified_id, usgs_mag, kandilli_mag, mag_disagreement,
               ROW_NUMBER() OVER (ORDER BY mag_disagreement DESC, unified_id) AS pos FROM dis)"""


@register("cross_source_disagreement", f"""{_DISAGREE}
SELECT 'Cross-source large disagreement' AS test_name, (SELECT count(*) FROM dis) AS disagreement_count,
       pos, unified_id, usgs_mag, kandilli_mag, mag_disagreement
FROM top WHERE pos <= 5 AND (SELECT count(*) FROM dis) > 0""")
def q_disagreement(spark, sf):
    return K.cross_source_disagreement(unify_events(_matches(spark, sf), AS_OF), AS_OF, threshold=0.5)


@register("top5_struct_agg", f"""{_DISAGREE}
SELECT pos, unified_id, usgs_mag, kandilli_mag, mag_disagreement FROM top WHERE pos <= 5""")
def q_top5(spark, sf):
    rows = K.disagreement_rows(unify_events(_matches(spark, sf), AS_OF), AS_OF, 0.5)
    agg = M.top_n_structs(rows, ["unified_id", "usgs_mag", "kandilli_mag", "mag_disagreement"],
                          [F.col("mag_disagreement").desc(), F.col("unified_id").asc()], 5)
    return agg.select(F.posexplode("top").alias("p", "t")).select(
        (F.col("p") + 1).cast("bigint").alias("pos"), "t.unified_id", "t.usgs_mag", "t.kandilli_mag",
        "t.mag_disagreement")


@register("expect_unique", f"""{O.FEEDS}
SELECT event_id, count(*) AS n_records FROM quake_raw WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1""")
def q_expect_unique(spark, sf):
    return K.expect_unique(testdata.quake_raw(testdata.table(spark, sf, "events")), "event_id")


@register("expect_unique_stg", f"""{O.FEEDS}
SELECT event_id AS earthquake_id, count(*) AS n_records FROM stg GROUP BY event_id HAVING count(*) > 1""")
def q_expect_unique_stg(spark, sf):
    s = _stg(spark, sf)
    out = None
    for df in s.values():
        part = K.expect_unique(df, "earthquake_id")
        out = part if out is None else out.unionByName(part)
    return out


@register("expect_not_null", f"""{O.FEEDS}
SELECT event_id AS earthquake_id, source FROM stg WHERE mag IS NULL""")
def q_expect_not_null(spark, sf):
    out = None
    for df in _stg(spark, sf).values():
        part = K.expect_not_null(df, "mag").select("earthquake_id", "source")
        out = part if out is None else out.unionByName(part)
    return out


@register("expect_accepted_values", """
SELECT event_type, count(*) AS n_records FROM events
WHERE event_type IS NOT NULL AND event_type NOT IN ('view', 'click', 'purchase', 'signup') GROUP BY event_type""")
def q_expect_accepted(spark, sf):
    return K.expect_accepted_values(testdata.table(spark, sf, "events"), "event_type",
                                    ["view", "click", "purchase", "signup"])


@register("contract_report", f"""{_BAD_STG}
SELECT 'unique_stg_key' AS contract, 'error' AS severity, count(*) AS failing_rows,
       CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT event_id FROM stg GROUP BY event_id HAVING count(*) > 1)
UNION ALL
SELECT 'not_null_mag', 'error', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
FROM stg WHERE mag IS NULL
UNION ALL
SELECT 'accepted_source', 'error', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END
FROM (SELECT source FROM stg WHERE source NOT IN ('usgs', 'emsc', 'kandilli') GROUP BY source)
UNION ALL
SELECT 'magnitude_range', 'warn', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END
FROM bad WHERE mag IS NOT NULL AND (mag < -2 OR mag > 10)""")
def q_contract_report(spark, sf):
    s = _stg(spark, sf)
    allstg = s["usgs"].unionByName(s["emsc"], allowMissingColumns=True).unionByName(
        s["kandilli"], allowMissingColumns=True)
    # Three contracts read the same staging union: compute it once.
    allstg = checkpointed(allstg.select("earthquake_id", "source", "mag"))
    return K.run_contracts([
        K.Contract("unique_stg_key", K.expect_unique(allstg, "earthquake_id")),
        K.Contract("not_null_mag", K.expect_not_null(allstg, "mag")),
        K.Contract("accepted_source", K.expect_accepted_values(allstg, "source", K.ACCEPTED_SOURCES)),
        K.Contract("magnitude_range", K.union_invalid(_bad_stg(spark, sf)), severity="warn"),
    ])


# --- cost ---------------------------------------------------------------------------------------

def _jobs(spark, sf):
    return testdata.job_log(testdata.table(spark, sf, "events"))


@register("job_filter", f"""{O.COST_FEEDS}
SELECT job_id, statement_type, query FROM jobs""")
def q_job_filter(spark, sf):
    return C.job_filter(_jobs(spark, sf), AS_OF).select("job_id", "statement_type", "query")


@register("model_cost", f"""{O.COST_FEEDS}
SELECT * FROM model_cost""")
def q_model_cost(spark, sf):
    return naive_ts(C.model_cost(_jobs(spark, sf), AS_OF))


@register("daily_cost", f"""{O.COST_FEEDS}
SELECT run_date, count(DISTINCT job_id) AS total_jobs, count(DISTINCT model_name) AS model_count,
       CAST(sum(bytes_processed) AS BIGINT) AS total_bytes_processed,
       CAST(sum(CAST(shadow_cost_usd AS DECIMAL(38,10))) AS DOUBLE) AS total_shadow_cost_usd,
       round(CAST(sum(CAST(shadow_cost_usd AS DECIMAL(38,10))) AS DOUBLE) / count(shadow_cost_usd), 10)
         AS avg_cost_per_model,
       round(CAST(sum(CAST(shadow_cost_usd AS DECIMAL(38,10))) AS DOUBLE) / nullif(count(DISTINCT model_name), 0), 10)
         AS cost_per_model_avg,
       {O.AS_OF_SQL} AS processed_at
FROM model_cost GROUP BY run_date""")
def q_daily_cost(spark, sf):
    return naive_ts(C.daily_cost(C.model_cost(_jobs(spark, sf), AS_OF), AS_OF))


@register("cost_totals", f"""{O.COST_FEEDS}
SELECT round(sum(bytes_processed) / 1024, 2) AS total_kb,
       round(CAST(sum(CAST(shadow_cost_usd AS DECIMAL(38,10))) AS DOUBLE) * 1e9, 4) AS cost_nano_usd
FROM model_cost""")
def q_cost_totals(spark, sf):
    return C.cost_totals(C.model_cost(_jobs(spark, sf), AS_OF))


@register("scan_totals", f"""WITH {O.BASELINE}
SELECT CAST(sum(bytes_processed) AS BIGINT) AS total_bytes,
       CAST(sum(bytes_processed) AS DOUBLE) * 5.0 / 1099511627776 AS total_cost_usd,
       CAST(sum(bytes_processed) AS DOUBLE) / 1099511627776 AS total_tib
FROM current_bytes""")
def q_scan_totals(spark, sf):
    return C.scan_totals(testdata.cost_current(testdata.table(spark, sf, "part")))


@register("cost_vs_baseline", f"""WITH {O.BASELINE}
SELECT c.model, c.bytes_processed AS current_bytes, b.bytes_processed AS baseline_bytes
FROM current_bytes c LEFT JOIN baseline b ON c.model = b.model""")
def q_cost_vs_baseline(spark, sf):
    part = testdata.table(spark, sf, "part")
    return C.cost_vs_baseline(testdata.cost_current(part), testdata.cost_baseline(part))


@register("cost_regression", f"""WITH {O.BASELINE},
j AS (SELECT c.model, c.bytes_processed AS current_bytes, b.bytes_processed AS baseline_bytes,
             CASE WHEN b.bytes_processed > 0
                  THEN CAST(c.bytes_processed - b.bytes_processed AS DOUBLE) / b.bytes_processed * 100 END AS inc
      FROM current_bytes c LEFT JOIN baseline b ON c.model = b.model)
SELECT model, current_bytes, baseline_bytes, round(inc, 4) AS increase_pct,
       round(CAST(current_bytes AS DOUBLE) * 5.0 / 1099511627776, 10) AS current_cost_usd,
       CASE WHEN current_bytes IS NULL THEN 'unknown' WHEN baseline_bytes IS NULL THEN 'new'
            WHEN inc > 20.0 THEN 'fail' ELSE 'pass' END AS status,
       (CASE WHEN current_bytes IS NULL THEN 'unknown' WHEN baseline_bytes IS NULL THEN 'new'
            WHEN inc > 20.0 THEN 'fail' ELSE 'pass' END) IN ('pass', 'new') AS passed
FROM j""")
def q_cost_regression(spark, sf):
    part = testdata.table(spark, sf, "part")
    return C.cost_regression(testdata.cost_current(part), testdata.cost_baseline(part))


@register("baseline_update", f"""WITH {O.BASELINE},
measured AS (SELECT * FROM current_bytes WHERE NOT ends_with(model, '1'))
SELECT model, bytes_processed, round(CAST(bytes_processed AS DOUBLE) * 5.0 / 1099511627776, 10) AS shadow_cost_usd
FROM baseline WHERE model NOT IN (SELECT model FROM measured)
UNION ALL
SELECT model, bytes_processed, round(CAST(bytes_processed AS DOUBLE) * 5.0 / 1099511627776, 10) FROM measured""")
def q_baseline_update(spark, sf):
    part = testdata.table(spark, sf, "part")
    measured = testdata.cost_current(part).where(~F.col("model").endswith("1"))
    return C.baseline_update(testdata.cost_baseline(part), measured)


# --- 2.B upsert -------------------------------------------------------------------------------


def _merge_out(df, spec):
    return naive_ts(df.select(
        F.col(spec.key).alias("k"), "ingestion_id", "ingestion_time", F.col(spec.time_col).alias("t"),
        F.col(spec.version).alias("v"), "mag", "lon", "lat", "raw_json"))


_MERGE_SELECT = "SELECT k, " + ", ".join(O.MERGE_COLS) + " FROM merged"


def _make_merge(src: str):
    def q(spark, sf):
        spec = SPECS[src]
        t, s = testdata.merge_inputs(testdata.table(spark, sf, "events"), src)
        return _merge_out(U.merge_spec(t, s, spec), spec)

    return q


for _src in ("usgs", "emsc", "kandilli"):
    register(f"merge_{_src}", f"{O.merge_ctes(_src)}\n{_MERGE_SELECT}")(_make_merge(_src))


@register("merge_affected", f"""{O.merge_ctes('usgs')}
SELECT CAST(count(*) FILTER (WHERE action = 'insert') AS BIGINT) AS rows_inserted,
       CAST(count(*) FILTER (WHERE action = 'update') AS BIGINT) AS rows_updated,
       CAST(0 AS BIGINT) AS rows_deleted,
       CAST(count(*) FILTER (WHERE action IN ('insert', 'update')) AS BIGINT) AS rows_affected
FROM merged""")
def q_merge_affected(spark, sf):
    spec = SPECS["usgs"]
    t, s = testdata.merge_inputs(testdata.table(spark, sf, "events"), "usgs")
    return U.upsert_counts(t, s, spec.key, spec.version)


@register("merge_idempotent", """
SELECT CAST(0 AS BIGINT) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted,
       CAST(0 AS BIGINT) AS rows_affected""")
def q_merge_idempotent(spark, sf):
    """Applying the same batch a second time affects nothing."""
    spec = SPECS["usgs"]
    t, s = testdata.merge_inputs(testdata.table(spark, sf, "events"), "usgs")
    once = checkpointed(U.merge_spec(t, s, spec))
    return U.upsert_counts(once, s, spec.key, spec.version)


@register("merge_days_usgs", f"{O.merge_ctes('usgs')}\n{_MERGE_SELECT}")
def q_merge_days(spark, sf):
    """Storage-level MERGE: rewrite only the touched day partitions of a Parquet table."""
    spec = SPECS["usgs"]
    t, s = testdata.merge_inputs(testdata.table(spark, sf, "events"), "usgs")
    path = sinks.table_path(spark, "raw_usgs")
    sinks.write_days(t.withColumn("event_date", F.to_date(spec.time_col)), path, "event_date", cluster_by=None,
                     overwrite_all=True)
    U.merge_into_days(spark, path, s, spec)
    return _merge_out(spark.read.parquet(path).drop("event_date"), spec)


def _snapshot_target(spark, sf, src: str) -> tuple[DayTable, DataFrame]:
    """The feed's raw table as a snapshot table holding the merge target, and the batch."""
    t, s = testdata.merge_inputs(testdata.table(spark, sf, "events"), src)
    table = DayTable(spark, sinks.table_path(spark, f"snapshot_{src}"))
    table.create(t.withColumn("event_date", F.to_date(SPECS[src].time_col)))
    return table, s


def _make_snapshot_merge(src: str):
    def q(spark, sf):
        """Storage-level MERGE as a new version of a snapshot table."""
        table, s = _snapshot_target(spark, sf, src)
        U.merge_snapshot(table, s, SPECS[src])
        return _merge_out(table.read().drop("event_date"), SPECS[src])

    return q


for _src in ("usgs", "emsc", "kandilli"):
    register(f"merge_snapshot_{_src}", f"{O.merge_ctes(_src)}\n{_MERGE_SELECT}")(_make_snapshot_merge(_src))


@register("snapshot_versions", f"""{O.merge_ctes('usgs')},
told AS (SELECT 0 AS version, k, v, mag FROM tgt UNION ALL SELECT 1, k, v, mag FROM merged)
SELECT version, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(v) AS BIGINT) AS n_versions, CAST(count(mag) AS BIGINT) AS n_mags FROM told GROUP BY 1""")
def q_snapshot_versions(spark, sf):
    """Both versions of a table stay readable: before the merge and after it; a replayed batch adds none."""
    spec = SPECS["usgs"]
    table, s = _snapshot_target(spark, sf, "usgs")
    for _ in range(2):
        U.merge_snapshot(table, s, spec)
    out = None
    for v in table.versions():
        part = table.read(v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("n_rows"), F.count(spec.version).alias("n_versions"), F.count("mag").alias("n_mags"))
        out = part if out is None else out.unionByName(part)
    return out


@register("build_days_daily", f"""{O.merged_stg()}
{O.daily_sql('stg')}""")
def q_build_days(spark, sf):
    """Daily mart after a build, a merge into all three feeds and a second build of the touched days."""
    raw, batches = {}, {}
    for src in SPECS:
        raw[src], batches[src] = _snapshot_target(spark, sf, src)
    root = sinks.table_path(spark, "build_days")
    models.build_days(spark, raw, root, AS_OF)
    for src, b in batches.items():
        U.merge_snapshot(raw[src], b, SPECS[src])
    return naive_ts(models.build_days(spark, raw, root, AS_OF)["dm_daily"].read())


# --- 2.A sources, sinks, landing -------------------------------------------------------------

@register("archive_raw", """
SELECT 'events' AS source, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       strftime(ts, '%H') AS hour, substr(md5(replace(props, ' ', '')), 1, 8) AS content_hash, props AS doc FROM events""")
def q_archive_raw(spark, sf):
    ev = testdata.table(spark, sf, "events")
    path = sinks.table_path(spark, "archive")
    L.archive_raw(ev.select(F.col("props").alias("doc"), F.col("ts").cast("timestamp").alias("ingestion_time")),
                  path, source="events")
    return L.read_archive(spark, path).select("source", "year", "month", "day", "hour", "content_hash", "doc")


@register("archive_replay", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_docs FROM (SELECT DISTINCT ts, event_id FROM events) GROUP BY 1""")
def q_archive_replay(spark, sf):
    """Documents per day after the same batch was archived twice, each event a document of its own."""
    ev = testdata.table(spark, sf, "events")
    path = sinks.table_path(spark, "archive")
    docs = ev.select(F.to_json(F.struct("event_id", "props")).alias("doc"), F.col("ts").cast("timestamp").alias("ingestion_time"))
    for _ in range(2):
        L.archive_raw(docs, path, source="events")
    return L.read_archive(spark, path).groupBy(F.concat_ws("-", "year", "month", "day").alias("day")).agg(F.count(F.lit(1)).alias("n_docs"))


@register("content_hash", "SELECT page_id, substr(md5(url), 1, 8) AS content_hash FROM pages")
def q_content_hash(spark, sf):
    return testdata.table(spark, sf, "pages").select("page_id", content_hash("url").alias("content_hash"))


@register("staging_name", "SELECT page_id, substr(lower(replace(url, '-', '')), 1, 8) AS staging_name FROM pages")
def q_staging_name(spark, sf):
    return testdata.table(spark, sf, "pages").select("page_id", staging_name("url").alias("staging_name"))


@register("load_ndjson", f"""{O.FEEDS}
SELECT event_id, event_time, updated, mag, lon, lat, place, event_id || '#' || CAST(version AS VARCHAR) AS raw_json
FROM quake_raw WHERE source = 'usgs'""")
def q_load_ndjson(spark, sf):
    raw = testdata.raw_feeds(spark, sf)["usgs"]
    path = sinks.table_path(spark, "ndjson")
    L.write_ndjson(raw, path)
    back = L.load_ndjson(spark, path, SPECS["usgs"].raw_schema)
    return naive_ts(back.select("event_id", "event_time", "updated", "mag", "lon", "lat", "place", "raw_json"))


@register("ingest_stamp", f"""{O.FEEDS}
SELECT event_id, 'batch-0001' AS ingestion_id, {O.AS_OF_SQL} AS ingestion_time FROM quake_base WHERE source = 'usgs'""")
def q_ingest_stamp(spark, sf):
    ev = testdata.quake_base(testdata.table(spark, sf, "events")).where(F.col("source") == "usgs")
    return naive_ts(FD.to_raw(ev, SPECS["usgs"], "batch-0001", AS_OF).select(
        "event_id", "ingestion_id", "ingestion_time"))


def _to_raw_sql(src: str) -> str:
    cols = [f"{e} AS {c}" for c, e in _raw_column_sql(src).items()]
    return f"{O.FEEDS}\nSELECT {', '.join(cols)} FROM quake_raw WHERE source = '{src}'"


def _make_to_raw(src: str):
    def q(spark, sf):
        return naive_ts(testdata.raw_feeds(spark, sf)[src])

    return q


for _src in ("usgs", "emsc", "kandilli"):
    register(f"to_raw_{_src}", _to_raw_sql(_src))(_make_to_raw(_src))


def _docs_roundtrip(spark, sf, render, parser):
    """Render feed rows as documents, land them as text lines, read and parse them back."""
    q = testdata.quake_raw(testdata.table(spark, sf, "events"))
    path = sinks.table_path(spark, "docs")
    render(q).select("doc").write.mode("overwrite").text(path)
    docs = spark.read.text(path).select(F.col("value").alias("doc"))
    return parser(docs)


_PARSED = "source, event_id, event_time, updated, mag, place, lon, lat, depth_km"


@register("parse_usgs", f"""{O.FEEDS}
SELECT source, event_id, date_trunc('millisecond', event_time) AS event_time,
       date_trunc('millisecond', updated) AS updated, mag, place, lon, lat, depth_km
FROM quake_raw WHERE source = 'usgs'""")
def q_parse_usgs(spark, sf):
    return naive_ts(_docs_roundtrip(spark, sf, D.usgs_documents, FD.parse_usgs).select(*_PARSED.split(", ")))


@register("parse_emsc", f"""{O.FEEDS}
SELECT source, event_id, event_time, date_trunc('millisecond', updated) AS updated, mag, place, lon, lat,
       depth_km
FROM quake_raw WHERE source = 'emsc'""")
def q_parse_emsc(spark, sf):
    return naive_ts(_docs_roundtrip(spark, sf, D.emsc_documents, FD.parse_emsc).select(*_PARSED.split(", ")))


@register("parse_kandilli", f"""{O.FEEDS}
SELECT source, event_id, date_trunc('second', event_time) AS event_time,
       date_trunc('second', updated) AS created_at, mag, place, lon, lat, depth_km
FROM quake_raw WHERE source = 'kandilli'""")
def q_parse_kandilli(spark, sf):
    out = _docs_roundtrip(spark, sf, D.kandilli_documents, FD.parse_kandilli)
    return naive_ts(out.select("source", "event_id", "event_time", "created_at", "mag", "place", "lon", "lat",
                               "depth_km"))


# --- 2.J streaming ------------------------------------------------------------------------------


def _land(df: DataFrame, ts: str, name: str, slices: int = 6, late: Column | None = None) -> str:
    """``df`` as Parquet files that land in time order; rows of ``late`` come with the last file."""
    spark = df.sparkSession
    path = sinks.table_path(spark, name)
    us = F.unix_micros(ts)
    lo, hi = checkpointed(df.agg(F.min(us), F.max(us))).first()
    place = F.least(F.floor((us - lo) * slices / (hi - lo + 1)), F.lit(slices - 1))
    if late is not None:
        place = F.when(late, slices - 1).otherwise(place)
    sliced = sinks.table_path(spark, f"{name}_slices")  # each slice a folder of its own: its file is made from its rows alone
    df.withColumn("_slice", place).write.partitionBy("_slice").parquet(sliced)
    rows = spark.read.schema(StructType([*df.schema.fields, StructField("_slice", IntegerType())])).parquet(sliced)
    for k in range(slices):
        rows.where(F.col("_slice") == k).drop("_slice").coalesce(1).write.mode("append").parquet(path)
    return path


def _landed(spark, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@register("stream_ingest", f"{O.merge_ctes('usgs')}\n{_MERGE_SELECT}")
def q_stream_ingest(spark, sf):
    """Batch rows land as NDJSON files (all versions of a key in one file); a file-source
    stream MERGEs them micro-batch by micro-batch into the day-partitioned raw table."""
    spec = SPECS["usgs"]
    t, s = testdata.merge_inputs(testdata.table(spark, sf, "events"), "usgs")
    target = sinks.table_path(spark, "raw_usgs")
    sinks.write_days(t.withColumn("event_date", F.to_date(spec.time_col)), target, "event_date", cluster_by=None,
                     overwrite_all=True)
    landing = sinks.table_path(spark, "landing_usgs")
    L.write_ndjson(s.repartition(4, spec.key), landing)
    J.run_to_end(J.stream_ingest(spark, landing, spec.raw_schema, spec, target, max_files_per_trigger=1))
    return _merge_out(spark.read.parquet(target).drop("event_date"), spec)


@register("stream_hourly_counts", f"""{O.FEEDS}
SELECT date_trunc('hour', event_time) AS hour_bucket, count(*) AS event_count FROM quake_raw
WHERE source = 'usgs' GROUP BY 1""")
def q_stream_hourly(spark, sf):
    """A fiftieth of the rows lands days too late: the watermarked stream counts the others, a replay the late ones."""
    raw = testdata.raw_feeds(spark, sf)["usgs"]
    late = F.pmod(F.xxhash64("event_id"), F.lit(50)) == 0
    path = _land(raw, "event_time", "landing_hourly", late=late)
    root, target = sinks.table_path(spark, "routed"), sinks.table_path(spark, "hourly_counts")
    J.run_to_end(J.route_late(spark, _landed(spark, path, raw.schema), "event_time", "1 hour", root))
    J.run_to_end(J.stream_hourly_counts(spark, J.on_time_rows(spark, root, raw.schema, 1), "event_time", target, delay="1 hour"))
    for _ in range(2):  # the second replay adds nothing
        J.add_late_counts(spark, J.late_rows(spark, root, raw.schema), "event_time", target)
    return naive_ts(spark.read.parquet(target).select("hour_bucket", "event_count"))


@register("stream_late_rows", f"""{O.FEEDS},
place AS (SELECT *, least(floor((epoch_us(event_time) - lo) * 6 / (hi - lo + 1)), 5) AS slice
  FROM quake_raw, (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi FROM quake_raw WHERE source = 'kandilli') WHERE source = 'kandilli'),
arrival AS (SELECT *, CASE WHEN n % 40 = 3 THEN 5 ELSE slice END AS came FROM place),
newest AS (SELECT came, max(event_time) AS seen FROM arrival GROUP BY 1)
SELECT CAST(event_time AS DATE) AS day, count(*) AS n_late FROM arrival
WHERE event_time < (SELECT max(seen) FROM newest WHERE newest.came < arrival.came) - INTERVAL 2 HOUR GROUP BY 1""")
def q_stream_late_rows(spark, sf):
    """Rows that a two-hour watermark would have dropped, by day."""
    spec, raw = SPECS["kandilli"], testdata.raw_feeds(spark, sf)["kandilli"]
    number = F.regexp_extract(spec.key, r"([0-9]+)$", 1).cast("bigint")
    path, root = _land(raw, spec.time_col, "landing_late", late=number % 40 == 3), sinks.table_path(spark, "routed")
    J.run_to_end(J.route_late(spark, _landed(spark, path, raw.schema), spec.time_col, "2 hours", root))
    return J.late_rows(spark, root, raw.schema).groupBy(F.to_date(spec.time_col).alias("day")).agg(F.count(F.lit(1)).alias("n_late"))


def _candidate_stream(spark, sf, packs=False):
    """Candidate pairs of both sides landing in time order, joined under a short watermark."""
    s = _stg(spark, sf)
    sides = [s[side].select(*matching.EVENT_COLS) for side in ("usgs", "kandilli")]
    left, right = (_landed(spark, _land(df, "event_time", "landing_side"), df.schema) for df in sides)
    return J.stream_candidates(left, right, delay="1 hour", packs=packs)


def _streamed_candidates(spark, sf, packs=False):
    out = sinks.table_path(spark, "candidates")
    J.run_to_end(J.land_candidates(spark, _candidate_stream(spark, sf, packs), out))
    return spark.read.parquet(out)


@register("stream_candidates", f"""{O.FEEDS},{O.matcher_ctes()}
SELECT {_CAND_COLS} FROM near""")
def q_stream_candidates(spark, sf):
    return naive_ts(_streamed_candidates(spark, sf).withColumn("distance_km", F.round("distance_km", 6)))


@register("stream_match", f"""{O.FEEDS},{O.matcher_ctes()}
SELECT {_CAND_COLS} FROM couple""")
def q_stream_match(spark, sf):
    """All candidate pairs land in packed form; those that are the nearest of either event in a packed row are ranked."""
    best = matching.mutual_best(unpacked(_streamed_candidates(spark, sf, packs=True), nearest=True))
    return naive_ts(best.withColumn("distance_km", F.round("distance_km", 6)))


# --- remaining inventory items ------------------------------------------------------------------


@register("write_ndjson", f"""{O.FEEDS}
SELECT event_id, mag FROM quake_raw WHERE source = 'emsc'""")
def q_write_ndjson(spark, sf):
    """Staging rows as newline-delimited JSON: one JSON object per text line."""
    raw = testdata.raw_feeds(spark, sf)["emsc"]
    path = sinks.table_path(spark, "ndjson")
    L.write_ndjson(raw, path)
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", "$.event_id").alias("event_id"),
                        F.get_json_object("value", "$.mag").cast("double").alias("mag"))


@register("materialize_unified", f"""{O.FEEDS},{O.matcher_ctes()},{O.UNIFIED_CTE}
SELECT *, CAST(event_time AS DATE) AS event_date FROM unified""")
def q_materialize_unified(spark, sf):
    """Full rebuild of a table, day-partitioned and clustered by match status."""
    u = unify_events(_matches(spark, sf), AS_OF).withColumn("event_date", F.to_date("event_time"))
    path = sinks.table_path(spark, "fct_unified")
    sinks.write_table(u, path, partition_by="event_date", cluster_by="match_status")
    return naive_ts(spark.read.parquet(path))


@register("store_failures", f"""{O.FEEDS}
SELECT event_id AS earthquake_id, source, event_time FROM stg WHERE mag IS NULL""")
def q_store_failures(spark, sf):
    s = _stg(spark, sf)
    allstg = s["usgs"].unionByName(s["emsc"], allowMissingColumns=True).unionByName(
        s["kandilli"], allowMissingColumns=True)
    root = sinks.table_path(spark, "audit")
    K.store_failures([K.Contract("not_null_mag",
                                 K.expect_not_null(allstg, "mag").select("earthquake_id", "source", "event_time"))],
                     root)
    return naive_ts(spark.read.parquet(f"{root}/not_null_mag"))


@register("baseline_read", f"""WITH {O.BASELINE}
SELECT model, bytes_processed, round(CAST(bytes_processed AS DOUBLE) * 5.0 / 1099511627776, 10) AS shadow_cost_usd
FROM baseline""")
def q_baseline_read(spark, sf):
    part = testdata.table(spark, sf, "part")
    b = testdata.cost_baseline(part)
    path = sinks.table_path(spark, "cost_baseline")
    C.write_baseline(b.select("model", "bytes_processed",
                              C.shadow_cost(F.col("bytes_processed")).alias("shadow_cost_usd")), path)
    return C.read_baseline(spark, path)


@register("cost_gate", f"""WITH {O.BASELINE},
j AS (SELECT c.model, c.bytes_processed AS cur, b.bytes_processed AS base,
             CASE WHEN b.bytes_processed > 0
                  THEN CAST(c.bytes_processed - b.bytes_processed AS DOUBLE) / b.bytes_processed * 100 END AS inc
      FROM current_bytes c LEFT JOIN baseline b ON c.model = b.model),
r AS (SELECT cur IS NOT NULL AND (base IS NULL OR inc IS NULL OR inc <= 20.0) AS passed FROM j)
SELECT coalesce(bool_and(passed), true) AS passed, count(*) AS models_checked,
       CAST(sum(CASE WHEN NOT passed THEN 1 ELSE 0 END) AS BIGINT) AS models_failed FROM r""")
def q_cost_gate(spark, sf):
    part = testdata.table(spark, sf, "part")
    return C.regression_passed(C.cost_regression(testdata.cost_current(part), testdata.cost_baseline(part)))


_PAIR_SQL = f"""{O.FEEDS},
u AS (SELECT * FROM stg WHERE source = 'usgs'), k AS (SELECT * FROM stg WHERE source = 'kandilli')
"""


def _pairs(spark, sf):
    s = _stg(spark, sf)
    num = lambda c: F.regexp_extract(F.col(c), r"([0-9]+)$", 1).cast("bigint")
    u = s["usgs"].select(num("earthquake_id").alias("n"), F.col("event_time").alias("ut"),
                         F.col("lat").alias("ulat"), F.col("lon").alias("ulon"))
    k = s["kandilli"].select(num("earthquake_id").alias("n"), F.col("event_time").alias("kt"),
                             F.col("lat").alias("klat"), F.col("lon").alias("klon"))
    return u.join(k, "n")


@register("haversine_km", _PAIR_SQL + """SELECT u.n,
  round(12742.0 * asin(sqrt(least(1.0, pow(sin((k.lat - u.lat) * (pi() / 360)), 2)
        + cos(u.lat * (pi() / 180)) * cos(k.lat * (pi() / 180)) * pow(sin((k.lon - u.lon) * (pi() / 360)), 2)))), 6)
  AS distance_km
FROM u JOIN k ON u.n = k.n""")
def q_haversine(spark, sf):
    p = _pairs(spark, sf)
    return p.select("n", F.round(geo.haversine_km("ulat", "ulon", "klat", "klon"), 6).alias("distance_km"))


@register("time_diff_seconds", _PAIR_SQL + """SELECT u.n, abs(date_sub('second', k.event_time, u.event_time))
  AS time_diff_seconds FROM u JOIN k ON u.n = k.n""")
def q_time_diff(spark, sf):
    return _pairs(spark, sf).select("n", times.seconds_between("ut", "kt").alias("time_diff_seconds"))


@register("bbox_flag", _PAIR_SQL + """SELECT u.n,
  coalesce(k.lat, u.lat) BETWEEN 35 AND 43 AND coalesce(k.lon, u.lon) BETWEEN 25 AND 46 AS in_region
FROM u JOIN k ON u.n = k.n""")
def q_bbox(spark, sf):
    p = _pairs(spark, sf)
    return p.select("n", geo.in_box(F.coalesce("klat", "ulat"), F.coalesce("klon", "ulon")).alias("in_region"))


@register("parse_local_ts", """
SELECT event_id, date_trunc('second', CAST(ts AS TIMESTAMP)) AS parsed FROM events""")
def q_parse_local(spark, sf):
    """Wall-clock Istanbul text (dotted date) rendered from ``events.ts`` and parsed back to UTC."""
    ev = testdata.table(spark, sf, "events")
    local = F.date_format(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Europe/Istanbul"),
                          "yyyy.MM.dd HH:mm:ss")
    return naive_ts(ev.select("event_id", times.parse_local_ts(local).alias("parsed")))


@register("parse_iso_utc", """
SELECT event_id, CAST(ts AS TIMESTAMP) AS parsed FROM events""")
def q_parse_iso(spark, sf):
    ev = testdata.table(spark, sf, "events")
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return naive_ts(ev.select("event_id", times.parse_iso_utc(iso).alias("parsed")))


@register("epoch_ms_to_ts", """
SELECT event_id, date_trunc('millisecond', CAST(ts AS TIMESTAMP)) AS parsed FROM events""")
def q_epoch_ms(spark, sf):
    ev = testdata.table(spark, sf, "events")
    return naive_ts(ev.select("event_id", times.epoch_ms_to_ts(F.unix_millis(F.col("ts").cast("timestamp")))
                              .alias("parsed")))


@register("to_utc_iso", """
SELECT event_id, CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00' AS iso FROM events""")
def q_to_utc_iso(spark, sf):
    ev = testdata.table(spark, sf, "events")
    return ev.select("event_id", times.to_utc_iso(F.col("ts").cast("timestamp")).alias("iso"))


# Inventory aliases: the same query serves two inventory rows.
register("union_invalid", ORACLE["range_invalid"])(q_range_invalid)
register("union_source_stats", ORACLE["source_24h_stats"])(q_source_24h)
register("having_positive", ORACLE["magnitude_range"])(q_magnitude_range)


@register("ingest_batch", O.ingest_counts_sql("usgs"))
def q_ingest_batch(spark, sf):
    """The ingest endpoint as a function: documents in, (status, counts) out."""
    spec = SPECS["usgs"]
    ev = testdata.table(spark, sf, "events")
    t, _ = testdata.merge_inputs(ev, "usgs")
    target = sinks.table_path(spark, "raw_usgs")
    sinks.write_days(t.withColumn("event_date", F.to_date(spec.time_col)), target, "event_date", cluster_by=None,
                     overwrite_all=True)
    q = testdata.quake_raw(ev)
    q = q.where((F.col("n") % 2 == 0)).withColumn(
        "updated", F.when(F.col("n") % 7 == 0, F.lit(None)).otherwise(F.col("updated")))
    docs = D.usgs_documents(q)
    return ingest_batch(spark, docs, "usgs", target, "batch-0001", AS_OF,
                        archive=sinks.table_path(spark, "archive"))


def _build(spark, sf, job_log=None):
    """One model build; its queries report failed contracts instead of stopping at them."""
    root = sinks.table_path(spark, "models")
    return models.build_models(spark, testdata.raw_feeds(spark, sf), root, AS_OF, job_log=job_log, stop_on_error=False)


@register("build_models_unified", f"""{O.FEEDS},{O.matcher_ctes('7 DAY')},{O.UNIFIED_CTE}
SELECT *, CAST(event_time AS DATE) AS event_date FROM unified""")
def q_build_unified(spark, sf):
    """Whole model graph materialised once; the unified table read back."""
    return naive_ts(spark.read.parquet(_build(spark, sf)["fct_unified"]))


def _contract_report_sql(every: bool = False) -> str:
    """Failing rows of each contract, counted; the status follows from the count and the severity."""
    at, hours = O.AS_OF_SQL, lambda d: f"INTERVAL {int(d.total_seconds() // 3600)} HOUR"
    lo, hi = K.MAG_RANGE
    accepted = ", ".join(f"'{v}'" for v in K.ACCEPTED_MATCH_STATUS)
    counts = {}
    for f in ("usgs", "emsc", "kandilli"):
        counts[f"unique_{f}"] = f"SELECT count(*) FROM (FROM stg SELECT event_id WHERE source = '{f}' AND event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        counts[f"not_null_time_{f}"] = f"SELECT count(*) FROM stg WHERE source = '{f}' AND event_time IS NULL"
    counts["unique_unified_id"] = "SELECT count(*) FROM (FROM unified SELECT unified_id WHERE unified_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    counts["accepted_match_status"] = f"SELECT count(DISTINCT match_status) FROM unified WHERE match_status NOT IN ({accepted})"
    counts["magnitude_range"] = (
        f"SELECT CAST(count(*) > 0 AS BIGINT) FROM stg WHERE source IN ('usgs', 'kandilli') AND mag NOT BETWEEN {lo} AND {hi} AND event_time >= {at} - {hours(K.RANGE_WINDOW)}")
    counts["cross_source_disagreement"] = (
        f"SELECT count(*) FROM unified WHERE match_status = 'matched' AND mag_disagreement > {K.DISAGREEMENT_THRESHOLD} AND event_time >= {at} - {hours(K.RANGE_WINDOW)}")
    for f in ("usgs", "kandilli"):
        counts[f"freshness_{f}"] = (
            f"SELECT CAST(count(*) = 0 AS BIGINT) FROM quake_raw WHERE source = '{f}' AND event_time >= {at} - {hours(min(K.FRESHNESS_MAX_AGE, K.FRESHNESS_SEARCH[f]))}")
    counts["min_events"] = (
        f"SELECT CAST(count(DISTINCT date_trunc('hour', event_time)) < {K.MIN_HOUR_BUCKETS} AS BIGINT) FROM quake_raw "
        f"WHERE source = 'usgs' AND event_time >= {at} - {hours(K.MIN_EVENTS_WINDOW)}")
    if every:
        counts["unique_match_id"] = "SELECT count(*) FROM (FROM matches SELECT match_id WHERE match_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        for f in ("usgs", "emsc", "kandilli"):
            counts |= {f"not_null_{c}_{f}": f"SELECT count(*) FROM stg WHERE source = '{f}' AND {c} IS NULL" for c in ("lon", "lat")}
            counts[f"accepted_source_{f}"] = f"SELECT count(DISTINCT source) FROM stg WHERE source = '{f}' AND source NOT IN ('usgs', 'emsc', 'kandilli')"
            for level, age in zip(("warn", "error"), K.SOURCE_FRESHNESS[f]):
                counts[f"loaded_{level}_{f}"] = (
                    f"SELECT CAST(count(*) = 0 AS BIGINT) FROM quake_raw WHERE source = '{f}' AND ingestion_time >= {at} - {hours(age)}")
        counts["unique_cost_job"] = "SELECT count(*) FROM (FROM model_cost SELECT job_id WHERE job_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        counts["unique_cost_day"] = "SELECT 0"  # the mart is grouped by day
        counts |= {f"not_null_cost_{c}": f"SELECT count(*) FROM model_cost WHERE {c} IS NULL" for c in ("job_id", "model_name", "bytes_processed", "run_date")}

    def severity(n: str) -> str:
        return "warn" if n == "cross_source_disagreement" or n.startswith("loaded_warn") else "error"

    parts = " UNION ALL ".join(f"SELECT '{n}' AS contract, '{severity(n)}' AS severity, ({q}) AS failing_rows" for n, q in counts.items())
    cost = f",{O.JOB_LOG},{O.JOB_FILTERED},{O.MODEL_COST}" if every else ""
    return f"""{O.FEEDS},{O.matcher_ctes('7 DAY')},{O.UNIFIED_CTE}{cost}, counted AS ({parts})
SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM counted"""


@register("build_models_report", _contract_report_sql())
def q_build_report(spark, sf):
    """Contract report of one model build (all pass on the driver data: mags in range, no > 2.0 gaps)."""
    return spark.read.parquet(_build(spark, sf)["contract_report"])


@register("build_models_contracts", _contract_report_sql(every=True))
def q_build_contracts(spark, sf):
    """Every contract of one build with the cost models, source freshness included; one scan a table."""
    paths = _build(spark, sf, _jobs(spark, sf))
    return spark.read.parquet(paths["contract_report"]).unionByName(spark.read.parquet(paths["contract_report_more"]))


@register("build_models_cost", f"""{O.COST_FEEDS}
SELECT * FROM model_cost""")
def q_build_cost(spark, sf):
    """The cost fact as the build stores it, partitioned by day."""
    out = spark.read.parquet(_build(spark, sf, _jobs(spark, sf))["fct_model_cost"])
    return naive_ts(out.select(*C.model_cost(_jobs(spark, sf), AS_OF).columns))


@register("build_models_daily_cost", ORACLE["daily_cost"])
def q_build_daily_cost(spark, sf):
    """The daily cost mart, built from the stored fact."""
    out = spark.read.parquet(_build(spark, sf, _jobs(spark, sf))["dm_daily_cost"])
    return naive_ts(out.select(*C.daily_cost(C.model_cost(_jobs(spark, sf), AS_OF), AS_OF).columns))


@register("stream_ingest_docs", O.merge_docs_sql("usgs"))
def q_stream_ingest_docs(spark, sf):
    """Feed documents land as text files; each micro-batch is parsed, stamped, archived and MERGEd."""
    spec = SPECS["usgs"]
    ev = testdata.table(spark, sf, "events")
    t, _ = testdata.merge_inputs(ev, "usgs")
    target = sinks.table_path(spark, "raw_usgs")
    sinks.write_days(t.withColumn("event_date", F.to_date(spec.time_col)), target, "event_date", cluster_by=None,
                     overwrite_all=True)
    # NULL versions only on single-version keys: two NULL-version rows for one key
    # in one batch have no defined winner (the reference's MERGE would reject
    # them); the tie then falls to the item's JSON text.  merge_usgs covers
    # NULL versions on multi-version keys with a reproducible raw_json.
    single = ~(F.col("n") % 10).isin(0, 2, 4)
    q = testdata.quake_raw(ev).where(F.col("n") % 2 == 0).withColumn(
        "updated", F.when((F.col("n") % 7 == 0) & single, F.lit(None)).otherwise(F.col("updated")))
    landing = sinks.table_path(spark, "landing_docs")
    # Both versions of an event sit in the same document, so arrival order cannot reorder them.
    D.usgs_documents(q).select("doc").repartition(2).write.text(landing)
    J.run_to_end(J.stream_ingest_docs(spark, landing, "usgs", target, archive=sinks.table_path(spark, "archive"),
                                      max_files_per_trigger=1))
    out = spark.read.parquet(target)
    return naive_ts(out.select(F.col(spec.key).alias("k"), F.col(spec.time_col).alias("t"),
                               F.col(spec.version).alias("v"), "mag", "lon", "lat"))


@register("cost_gate_run", ORACLE["cost_gate"])
def q_cost_gate_run(spark, sf):
    """The gate over a stored baseline document (some models grew > 20 %: fails, baseline kept)."""
    part = testdata.table(spark, sf, "part")
    path = sinks.table_path(spark, "cost_baseline")
    C.write_baseline(testdata.cost_baseline(part).withColumn(
        "shadow_cost_usd", C.shadow_cost(F.col("bytes_processed"))), path)
    return C.run_cost_gate(spark, testdata.cost_current(part), path)


@register("quarantine_rows", f"""{O.FEEDS}
SELECT event_id, 'unparseable date_time' AS reject_reason FROM quake_raw
WHERE source = 'kandilli' AND n % 53 = 0""")
def q_quarantine(spark, sf):
    """Items whose time text does not parse go to a quarantine frame, not silently away."""
    q = testdata.quake_raw(testdata.table(spark, sf, "events"))
    docs = D.kandilli_documents(q, corrupt_every=53)
    _, rejected = FD.split_rejects(FD.parse_kandilli(docs, keep_rejects=True))
    return rejected.select("event_id", "reject_reason")


@register("stream_mutual_best", ORACLE["mutual_best"])
def q_stream_mutual_best(spark, sf):
    """Mutual best kept current as candidate pairs stream in (in packed form), micro-batch by micro-batch."""
    stored, out = (DayTable(spark, sinks.table_path(spark, n)) for n in ("candidates", "matches"))
    J.run_to_end(J.stream_matches(spark, _candidate_stream(spark, sf, packs=True), stored, out))
    return naive_ts(out.read().drop("event_date").withColumn("distance_km", F.round("distance_km", 6)))
