"""Data contracts.  Each returns its *failing rows*; an empty result passes.

``run_contracts`` turns a list of contracts into one report DataFrame
``(contract, severity, failing_rows, status)``: counting happens on the
executors, nothing is collected.  Contracts made by the functions under
"counted contracts" say which rows of which table they look at, and all that
look at one table are counted in one scan of it; their failing rows are read
only to store the failures of a contract that failed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seisma.functions.times import minutes_between
from seisma.operators.marts import count_with_top, hourly_counts, max_event_time

# Contract parameters of the reference.
ACCEPTED_SOURCES = ("usgs", "emsc", "kandilli")
ACCEPTED_MATCH_STATUS = ("matched", "usgs_only", "kandilli_only")
MAG_RANGE = (-2.0, 10.0)
FRESHNESS_MAX_AGE = dt.timedelta(minutes=120)
FRESHNESS_SEARCH = {"usgs": dt.timedelta(hours=24), "kandilli": dt.timedelta(hours=48)}
SOURCE_FRESHNESS = {  # warn after, error after (ingestion age)
    "usgs": (dt.timedelta(minutes=180), dt.timedelta(minutes=240)),
    "kandilli": (dt.timedelta(minutes=180), dt.timedelta(minutes=240)),
    "emsc": (dt.timedelta(minutes=360), dt.timedelta(minutes=480)),
}
MIN_EVENTS_WINDOW = dt.timedelta(hours=6)
MIN_HOUR_BUCKETS = 2
RANGE_WINDOW = dt.timedelta(days=7)
DISAGREEMENT_THRESHOLD = 2.0
DISAGREEMENT_TOP = 5


def _ts(v: dt.datetime) -> Column:
    return F.lit(v).cast("timestamp")


# --- generic column tests ---------------------------------------------------------------

def expect_unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their count."""
    return (
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def expect_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def expect_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Distinct non-NULL values outside ``values``, with counts."""
    return (
        df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values)).groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


# --- freshness ------------------------------------------------------------------------------

def source_freshness(df: DataFrame, loaded_at: str, warn_after: dt.timedelta, error_after: dt.timedelta,
                     as_of: dt.datetime, source: str = "") -> DataFrame:
    """Age of the newest load -> pass / warn / error (one row, always)."""
    age = (F.unix_micros(_ts(as_of)) - F.unix_micros(F.max(loaded_at))) / 1e6
    return df.agg(
        F.lit(source).alias("source"),
        F.max(loaded_at).alias("max_loaded_at"),
        age.alias("age_seconds"),
    ).withColumn(
        "status",
        F.when(F.col("max_loaded_at").isNull() | (F.col("age_seconds") > error_after.total_seconds()), "error")
        .when(F.col("age_seconds") > warn_after.total_seconds(), "warn")
        .otherwise("pass"),
    )


def event_freshness(df: DataFrame, ts: str, as_of: dt.datetime, search: dt.timedelta,
                    max_age: dt.timedelta = FRESHNESS_MAX_AGE, name: str = "freshness check") -> DataFrame:
    """Fails when the newest event within ``search`` is absent or older than ``max_age``."""
    latest = max_event_time(df, ts, as_of, search)
    return latest.where(
        F.col("latest_event_time").isNull() | (F.col("latest_event_time") < _ts(as_of - max_age))
    ).select(
        F.lit(name).alias("test_name"),
        "latest_event_time",
        minutes_between(_ts(as_of), F.col("latest_event_time")).alias("minutes_since_last_event"),
    )


def min_events(df: DataFrame, ts: str, as_of: dt.datetime, window: dt.timedelta = MIN_EVENTS_WINDOW,
               min_buckets: int = MIN_HOUR_BUCKETS) -> DataFrame:
    """Fails when fewer than ``min_buckets`` hour buckets hold events in the window."""
    hourly = hourly_counts(df, ts, as_of - window)
    return hourly.agg(
        F.lit("Min events check").alias("test_name"),
        F.count(F.lit(1)).alias("hours_with_events"),
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_events"),
    ).where(F.col("hours_with_events") < min_buckets)


# --- value checks ---------------------------------------------------------------------------

def range_invalid(df: DataFrame, col: str = "mag", lo: float = MAG_RANGE[0], hi: float = MAG_RANGE[1]) -> DataFrame:
    """Rows with a non-NULL value outside [lo, hi]."""
    return df.where(F.col(col).isNotNull() & ((F.col(col) < lo) | (F.col(col) > hi)))


def union_invalid(stg_tables: Sequence[DataFrame], col: str = "mag") -> DataFrame:
    out = None
    for df in stg_tables:
        part = range_invalid(df, col).select("earthquake_id", "source", col, "event_time")
        out = part if out is None else out.unionByName(part)
    return out


def magnitude_range(stg_tables: Sequence[DataFrame], as_of: dt.datetime,
                    window: dt.timedelta = RANGE_WINDOW) -> DataFrame:
    """Fails (one row with the count) if any out-of-range magnitude lies in the window."""
    inv = union_invalid(stg_tables).where(F.col("event_time") >= _ts(as_of - window))
    return inv.agg(
        F.lit("Magnitude range check").alias("test_name"), F.count(F.lit(1)).alias("invalid_count")
    ).where(F.col("invalid_count") > 0)


def disagreement_rows(unified: DataFrame, as_of: dt.datetime, threshold: float = DISAGREEMENT_THRESHOLD,
                      window: dt.timedelta = RANGE_WINDOW) -> DataFrame:
    return unified.where(
        (F.col("match_status") == "matched")
        & (F.col("mag_disagreement") > threshold)
        & (F.col("event_time") >= _ts(as_of - window))
    )


def cross_source_disagreement(unified: DataFrame, as_of: dt.datetime, threshold: float = DISAGREEMENT_THRESHOLD,
                              top: int = DISAGREEMENT_TOP, window: dt.timedelta = RANGE_WINDOW) -> DataFrame:
    """Warn-level: count of large disagreements with the top ``top`` rows (one row each)."""
    rows = disagreement_rows(unified, as_of, threshold, window)
    out = count_with_top(
        rows, [F.col("mag_disagreement").desc(), F.col("unified_id").asc()], top,
        ["unified_id", "usgs_mag", "kandilli_mag", "mag_disagreement"], count_name="disagreement_count",
    )
    return out.select(F.lit("Cross-source large disagreement").alias("test_name"), "*")


# --- runner ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Look:
    """The rows of a table that a contract looks at, with the value they are told apart by (NULL: not at all)."""

    table: DataFrame
    when: Column
    value: Column | None = None


#: What the rows looked at mean, from their number, that of distinct values, and that of values seen twice or more.
_FAILING = {
    "rows": lambda rows, values, repeated, least: rows,
    "values": lambda rows, values, repeated, least: values,
    "repeated": lambda rows, values, repeated, least: repeated,
    "any": lambda rows, values, repeated, least: (rows > 0).cast("bigint"),
    "none": lambda rows, values, repeated, least: (rows == 0).cast("bigint"),
    "fewer": lambda rows, values, repeated, least: (values < least).cast("bigint"),
}


@dataclass(frozen=True)
class Contract:
    name: str
    failing: DataFrame
    severity: str = "error"  # "error" fails the run, "warn" does not
    looks: tuple[Look, ...] = ()  # if given, the number of failing rows follows from these rows by ``reading``
    reading: str = "rows"
    least: int = 0


class ContractError(RuntimeError):
    """A contract of severity ``error`` has failing rows."""


# --- counted contracts ----------------------------------------------------------------------

def unique(name: str, df: DataFrame, col: str, severity: str = "error") -> Contract:
    """``expect_unique``, counted with the table's other contracts."""
    return Contract(name, expect_unique(df, col), severity, (Look(df, F.col(col).isNotNull(), _text(df, col)),), "repeated")


def not_null(name: str, df: DataFrame, col: str, severity: str = "error") -> Contract:
    return row_rule(name, df, F.col(col).isNull(), severity)


def row_rule(name: str, df: DataFrame, broken: Column, severity: str = "error") -> Contract:
    """Fails on every row for which ``broken`` is true."""
    return Contract(name, df.where(broken), severity, (Look(df, broken),))


def accepted_values(name: str, df: DataFrame, col: str, values: Sequence, severity: str = "error") -> Contract:
    look = Look(df, F.col(col).isNotNull() & ~F.col(col).isin(*values), _text(df, col))
    return Contract(name, expect_accepted_values(df, col, values), severity, (look,), "values")


def magnitudes_in_range(name: str, stg_tables: Sequence[DataFrame], as_of: dt.datetime, window: dt.timedelta = RANGE_WINDOW,
                        severity: str = "error") -> Contract:
    lo, hi = MAG_RANGE
    broken = F.col("mag").isNotNull() & ((F.col("mag") < lo) | (F.col("mag") > hi)) & (F.col("event_time") >= _ts(as_of - window))
    return Contract(name, magnitude_range(stg_tables, as_of, window), severity, tuple(Look(t, broken) for t in stg_tables), "any")


def small_disagreements(name: str, unified: DataFrame, as_of: dt.datetime, threshold: float = DISAGREEMENT_THRESHOLD,
                        window: dt.timedelta = RANGE_WINDOW, severity: str = "warn") -> Contract:
    broken = (F.col("match_status") == "matched") & (F.col("mag_disagreement") > threshold) & (F.col("event_time") >= _ts(as_of - window))
    return row_rule(name, unified, broken, severity)


def fresh_events(name: str, df: DataFrame, ts: str, as_of: dt.datetime, search: dt.timedelta, max_age: dt.timedelta = FRESHNESS_MAX_AGE,
                 severity: str = "error") -> Contract:
    look = Look(df, F.col(ts) >= _ts(as_of - min(search, max_age)))
    return Contract(name, event_freshness(df, ts, as_of, search, max_age), severity, (look,), "none")


def fresh_loads(name: str, df: DataFrame, loaded_at: str, max_age: dt.timedelta, as_of: dt.datetime, severity: str = "error") -> Contract:
    """Fails when no row was loaded within ``max_age``."""
    recent = F.col(loaded_at) >= _ts(as_of - max_age)
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    failing = newest.where(F.col("max_loaded_at").isNull() | (F.col("max_loaded_at") < _ts(as_of - max_age)))
    return Contract(name, failing, severity, (Look(df, recent),), "none")


def enough_events(name: str, df: DataFrame, ts: str, as_of: dt.datetime, window: dt.timedelta = MIN_EVENTS_WINDOW,
                  min_buckets: int = MIN_HOUR_BUCKETS, severity: str = "error") -> Contract:
    look = Look(df, F.col(ts) >= _ts(as_of - window), F.date_trunc("HOUR", F.col(ts)).cast("string"))
    return Contract(name, min_events(df, ts, as_of, window, min_buckets), severity, (look,), "fewer", min_buckets)


def _text(df: DataFrame, col: str) -> Column:
    """A value as text, equal where the values are."""
    kind = df.schema[col].dataType.typeName()
    if kind in ("float", "double"):
        return (F.col(col) + F.lit(0.0)).cast("string")  # -0.0 equals 0.0
    if kind == "binary":
        return F.hex(col)
    return F.to_json(F.struct(F.col(col))) if kind in ("array", "struct", "variant") else F.col(col).cast("string")


def _counts(contracts: Sequence[Contract]) -> DataFrame:
    """(contract, rows, values, repeated) of the contracts that have any row: one scan a table.

    A row gives an entry for each contract that looks at it (a unique key always, a broken rule seldom).  Entries are
    counted by contract and value, partially before the shuffle, so a value that many rows hold is a row a task.
    """
    by_table: dict[int, list[tuple[str, Look]]] = {}
    for c in contracts:
        for look in c.looks:
            by_table.setdefault(id(look.table), []).append((c.name, look))
    entries = None
    for looks in by_table.values():
        text = F.lit(None).cast("string")
        each = [F.when(x.when, F.struct(F.lit(n).alias("contract"), (text if x.value is None else x.value).alias("value"))) for n, x in looks]
        part = looks[0][1].table.select(F.explode(F.array_compact(F.array(*each))).alias("e")).select("e.*")
        entries = part if entries is None else entries.unionByName(part)
    n = F.count(F.lit(1))
    return (
        entries.groupBy("contract", "value").agg(n.alias("n"))
        .groupBy("contract").agg(F.sum("n").alias("rows"), n.alias("values"), F.count_if(F.col("n") > 1).alias("repeated"))
    )


def run_contracts(contracts: Sequence[Contract]) -> DataFrame:
    """Report ``(contract, severity, failing_rows, status)``.

    Counted contracts of one table share a scan; any other contract is an aggregate over its own failing rows.
    """
    out = None
    for c in contracts:
        if not c.looks:
            part = c.failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(
                F.lit(c.name).alias("contract"), F.lit(c.severity).alias("severity"), "failing_rows")
            out = part if out is None else out.unionByName(part)
    if counted := [c for c in contracts if c.looks]:
        zero, at = F.lit(0).cast("bigint"), F.col("contract")
        found = [F.coalesce(F.col(k), zero) for k in ("rows", "values", "repeated")]
        failing = F.coalesce(*(F.when(at == c.name, _FAILING[c.reading](*found, F.lit(c.least))) for c in counted))
        named = F.array(*(F.struct(F.lit(c.name).alias("contract"), F.lit(c.severity).alias("severity")) for c in counted))
        every = counted[0].looks[0].table.sparkSession.range(1).select(F.inline(named))  # a row for each contract, also of empty tables
        part = every.join(F.broadcast(_counts(counted)), "contract", "left").select(  # at most a row a contract
            "contract", "severity", failing.alias("failing_rows"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn(
        "status", F.when(F.col("failing_rows") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"))


def store_failures(contracts: Sequence[Contract], root: str) -> None:
    """Persist each contract's failing rows as a table ``root/<contract>`` (overwritten per run)."""
    for c in contracts:
        c.failing.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{c.name}")
