"""The model graph as plain function composition over lazy DataFrames.

raw feeds -> staging (dedup + normal form) -> matches -> unified -> marts.
Catalyst sees the whole tree of whatever a caller asks for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from seisma.operators.matching import DEFAULT, MatchConfig, reconcile
from seisma.operators.snapshots import DayTable
from seisma.operators.staging import stg
from seisma.operators.unify import unify_events
from seisma.session import checkpointed, read_if_exists
from seisma.sources import testdata
from seisma.sources.schemas import SPECS


def staged(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stg(df, SPECS[name]) for name, df in raw.items()}


def matches(stg_tables: dict[str, DataFrame], cfg: MatchConfig = DEFAULT,
            as_of: dt.datetime | None = None) -> DataFrame:
    return reconcile(stg_tables[cfg.left], stg_tables[cfg.right], cfg, as_of)


def unified(stg_tables: dict[str, DataFrame], processed_at: dt.datetime, cfg: MatchConfig = DEFAULT,
            as_of: dt.datetime | None = None) -> DataFrame:
    return unify_events(matches(stg_tables, cfg, as_of), processed_at, cfg)


# --- driver-table entry points ------------------------------------------------------

def test_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testdata.raw_feeds(spark, sf_dir)


def test_stg(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return staged(test_raw(spark, sf_dir))


# --- one run of the whole model graph, each model materialised once ---------------

def build_models(spark: SparkSession, raw: dict[str, DataFrame], root: str, as_of: dt.datetime,
                 cfg: MatchConfig = DEFAULT, refresh_days: int = 3, job_log: DataFrame | None = None,
                 stop_on_error: bool = True) -> dict[str, str]:
    """Materialise staging, reconciliation, marts and the contract report under ``root``.

    Every model is written once (day-partitioned where it has a day) and the
    next model reads the written table, so no model's lineage is recomputed by
    its consumers and an executor loss costs at most the current step.
    Staging and reconciliation are rebuilt in full (reconciliation over the
    ``cfg.lookback`` window); the daily mart is refreshed for the last
    ``refresh_days`` days when it exists (insert-overwrite), else built whole.
    With ``job_log`` the cost fact (by ``run_date``, clustered by model) and the
    daily cost mart are built and checked too.  The failing rows of every failed
    contract are stored under ``failures/``; a failed contract of severity
    ``error`` raises ``ContractError`` after the report is written, unless
    ``stop_on_error`` is false.  Returns the table paths.
    """
    from pyspark.sql import functions as F

    from seisma.operators import contracts as K
    from seisma.operators.marts import daily_stats
    from seisma.operators.sinks import write_days, write_table

    root = root.rstrip("/")
    paths: dict[str, str] = {}
    stg_tables: dict[str, DataFrame] = {}
    for name, df in raw.items():
        p = f"{root}/stg_{name}"
        write_days(stg(df, SPECS[name]).withColumn("event_date", F.to_date("event_time")), p, "event_date",
                   cluster_by=None, overwrite_all=True)
        stg_tables[name] = spark.read.parquet(p)  # keeps event_date: later filters prune days
        paths[f"stg_{name}"] = p

    m_path = f"{root}/int_matches"
    m = reconcile(stg_tables[cfg.left], stg_tables[cfg.right], cfg, as_of, materialize=False)
    write_table(m, m_path, cluster_by="match_status")
    paths["int_matches"] = m_path

    u_path = f"{root}/fct_unified"
    u = unify_events(spark.read.parquet(m_path), as_of, cfg).withColumn("event_date", F.to_date("event_time"))
    write_table(u, u_path, partition_by="event_date", cluster_by="match_status")
    paths["fct_unified"] = u_path

    d_path = f"{root}/dm_daily"
    if read_if_exists(spark, d_path) is not None:
        since = as_of.date() - dt.timedelta(days=refresh_days)
        write_days(daily_stats(stg_tables, as_of, since=since), d_path, "event_date")
    else:  # first run: full build
        write_days(daily_stats(stg_tables, as_of), d_path, "event_date", overwrite_all=True)
    paths["dm_daily"] = d_path

    unified, matched = spark.read.parquet(u_path), spark.read.parquet(m_path)
    suite = [K.unique(f"unique_{n}", t, "earthquake_id") for n, t in stg_tables.items()]
    suite += [K.not_null(f"not_null_time_{n}", t, "event_time") for n, t in stg_tables.items()]
    suite += [
        K.unique("unique_unified_id", unified, "unified_id"),
        K.accepted_values("accepted_match_status", unified, "match_status", K.ACCEPTED_MATCH_STATUS),
        K.magnitudes_in_range("magnitude_range", [stg_tables["usgs"], stg_tables["kandilli"]], as_of),
        K.small_disagreements("cross_source_disagreement", unified, as_of),
        *(K.fresh_events(f"freshness_{n}", raw[n], SPECS[n].time_col, as_of, K.FRESHNESS_SEARCH[n]) for n in ("usgs", "kandilli")),
        K.enough_events("min_events", raw["usgs"], SPECS["usgs"].time_col, as_of),
    ]
    more = [K.unique("unique_match_id", matched, "match_id")]
    for n, t in stg_tables.items():
        more += [K.not_null(f"not_null_{c}_{n}", t, c) for c in ("lon", "lat")]
        more.append(K.accepted_values(f"accepted_source_{n}", t, "source", list(SPECS)))
        warn, error = K.SOURCE_FRESHNESS[n]
        more += [K.fresh_loads(f"loaded_{level}_{n}", raw[n], "ingestion_time", age, as_of, level) for level, age in (("warn", warn), ("error", error))]
    if job_log is not None:
        from seisma.operators.cost import daily_cost, model_cost

        c_path, dc_path = f"{root}/fct_model_cost", f"{root}/dm_daily_cost"
        write_table(model_cost(job_log, as_of), c_path, partition_by="run_date", cluster_by="model_name")
        fact = spark.read.parquet(c_path)
        write_table(daily_cost(fact, as_of), dc_path, partition_by="run_date")
        daily = spark.read.parquet(dc_path)
        paths |= {"fct_model_cost": c_path, "dm_daily_cost": dc_path}
        more += [K.unique("unique_cost_job", fact, "job_id"), K.unique("unique_cost_day", daily, "run_date")]
        more += [K.not_null(f"not_null_cost_{c}", fact, c) for c in ("job_id", "model_name", "bytes_processed", "run_date")]

    r_path, more_path = f"{root}/contract_report", f"{root}/contract_report_more"
    K.run_contracts(suite).coalesce(1).write.mode("overwrite").parquet(r_path)
    K.run_contracts(more).coalesce(1).write.mode("overwrite").parquet(more_path)
    paths |= {"contract_report": r_path, "contract_report_more": more_path}
    report = {r.contract: r for p in (r_path, more_path) for r in spark.read.parquet(p).collect()}  # a row for each contract
    K.store_failures([c for c in (*suite, *more) if report[c.name].failing_rows], f"{root}/failures")
    failed = sorted(n for n, r in report.items() if r.status == "fail")
    if stop_on_error and failed:
        raise K.ContractError(f"failed contracts: {', '.join(failed)}")
    return paths


# --- incremental run over snapshot tables -----------------------------------------

def build_days(spark: SparkSession, raw: dict[str, DayTable], root: str, as_of: dt.datetime,
               cfg: MatchConfig = DEFAULT) -> dict[str, DayTable]:
    """Bring staging, the daily mart and the unified table up to the raw tables' newest versions.

    Raw tables hold one row per key (they are merged), so a staged day depends on that raw day alone:
    only days whose folder changed since the version staged last are read and staged again, and only
    those days of the daily mart.  A model's manifest carries the versions it was made from, in the
    same commit as its rows, so a run that dies is repeated or continued by the next one.  Matching
    reads the days of ``cfg.lookback``; the unified table is one new version of all its days.
    """
    from pyspark.sql import functions as F

    from seisma.operators.marts import daily_stats

    root = root.rstrip("/")
    stg_tables = {}
    for name, table in raw.items():
        out = stg_tables[name] = DayTable(spark, f"{root}/stg_{name}")
        done, version = out.manifest(), table.version()
        if version is None:
            raise ValueError(f"raw table {name} has no version")
        days = table.changed_since(done["note"].get("raw_version"), version)
        if days or done["version"] is None:
            rows = stg(table.read(version, days), SPECS[name]).withColumn("event_date", F.to_date("event_time"))
            out.replace(rows, days, done["version"], {"raw_version": version})

    daily = DayTable(spark, f"{root}/dm_daily")
    done, versions = daily.manifest(), {n: t.version() for n, t in stg_tables.items()}
    days = sorted({d for n, t in stg_tables.items() for d in t.changed_since(done["note"].get(n), versions[n])}, key=str)
    if days or done["version"] is None:
        stats = daily_stats({n: t.read(versions[n], days) for n, t in stg_tables.items()}, as_of)
        daily.replace(stats, days, done["version"], versions)

    since = (as_of - cfg.lookback).date()
    recent = {s: stg_tables[s].read(versions[s], [d for d in stg_tables[s].days(versions[s]) if d is not None and d >= since]) for s in (cfg.left, cfg.right)}
    unified_table = DayTable(spark, f"{root}/fct_unified")
    u = checkpointed(unified(recent, as_of, cfg, as_of).withColumn("event_date", F.to_date("event_time")))
    base = unified_table.version()
    days = {r[0] for r in u.select("event_date").distinct().collect()} | set(unified_table.days() if base is not None else [])  # calendar days
    unified_table.replace(u, days, base, versions)
    return {**{f"stg_{n}": t for n, t in stg_tables.items()}, "dm_daily": daily, "fct_unified": unified_table}
