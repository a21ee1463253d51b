"""Query-cost accounting: cost fact, daily cost mart, totals, regression gate."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, MapType, StringType, StructField, StructType
from pyspark.sql import functions as F

from seisma.operators.marts import exact_sum

# On-demand price model and the job-log filters of the cost fact.
PRICE_USD = 5.0
PRICE_UNIT_BYTES = 1099511627776  # 2**40 (one TiB)
MODEL_PATTERN = r"`[^`]+`\.`[^`]+`\.`([^`]+)`"
INCLUDE_LIKE = ("%staging.%", "%marts.%")
EXCLUDE_LIKE = ("%INFORMATION_SCHEMA%", "%staging_dbt_test__audit%")
STATEMENT_TYPES = ("SELECT", "INSERT", "CREATE_TABLE_AS_SELECT", "CREATE_VIEW")
LOOKBACK = dt.timedelta(days=30)
REGRESSION_THRESHOLD_PCT = 20.0


def shadow_cost(bytes_col: Column, digits: int | None = 10) -> Column:
    c = bytes_col.cast("double") * F.lit(PRICE_USD) / F.lit(PRICE_UNIT_BYTES)
    return F.round(c, digits) if digits is not None else c


def job_filter(job_log: DataFrame, as_of: dt.datetime, lookback: dt.timedelta = LOOKBACK,
               include_like=INCLUDE_LIKE, exclude_like=EXCLUDE_LIKE, statement_types=STATEMENT_TYPES) -> DataFrame:
    """Successful pipeline jobs of the last ``lookback`` (LIKE is case-sensitive, ``_`` a wildcard)."""
    q = F.col("query")
    inc = None
    for p in include_like:
        inc = q.like(p) if inc is None else inc | q.like(p)
    cond = inc
    for p in exclude_like:
        cond = cond & ~q.like(p)
    cond = (
        cond
        & (F.col("creation_time") >= F.lit(as_of - lookback).cast("timestamp"))
        & F.col("error_result").isNull()
        & F.col("statement_type").isin(*statement_types)
    )
    return job_log.where(cond)


def model_cost(job_log: DataFrame, as_of: dt.datetime, **filters) -> DataFrame:
    """Row-level cost fact: one row per job with model name, bytes, cost, run date."""
    jobs = job_filter(job_log, as_of, **filters)
    model = F.nullif(F.regexp_extract(F.col("query"), MODEL_PATTERN, 1), F.lit(""))
    return jobs.where(F.col("total_bytes_processed") > 0).select(
        F.col("job_id"),
        F.coalesce(model, F.lit("unknown")).alias("model_name"),
        F.col("job_type"),
        F.col("total_bytes_processed").alias("bytes_processed"),
        shadow_cost(F.col("total_bytes_processed")).alias("shadow_cost_usd"),
        F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")).alias("execution_time_seconds"),
        F.to_date("start_time").alias("run_date"),
        F.col("start_time"),
        F.col("end_time"),
        F.lit(as_of).cast("timestamp").alias("processed_at"),
    )


def daily_cost(cost: DataFrame, processed_at: dt.datetime) -> DataFrame:
    """Per run date: jobs, models, bytes, cost, mean cost per job, cost per model."""
    total = exact_sum("shadow_cost_usd")
    models = F.count_distinct("model_name")
    return cost.groupBy("run_date").agg(
        F.count_distinct("job_id").alias("total_jobs"),
        models.alias("model_count"),
        F.sum("bytes_processed").alias("total_bytes_processed"),
        total.alias("total_shadow_cost_usd"),
        F.round(total / F.count("shadow_cost_usd"), 10).alias("avg_cost_per_model"),
        F.round(total / F.nullif(models, F.lit(0)), 10).alias("cost_per_model_avg"),
        F.lit(processed_at).cast("timestamp").alias("processed_at"),
    )


def cost_totals(cost: DataFrame) -> DataFrame:
    """Total kB scanned and total cost in nano-dollars."""
    return cost.agg(
        F.round(F.sum("bytes_processed") / 1024, 2).alias("total_kb"),
        F.round(exact_sum("shadow_cost_usd") * 1e9, 4).alias("cost_nano_usd"),
    )


def scan_totals(per_model: DataFrame, bytes_col: str = "bytes_processed") -> DataFrame:
    """Sum of per-model bytes, its cost and its size in TiB."""
    b = F.sum(bytes_col)
    return per_model.agg(
        b.alias("total_bytes"),
        shadow_cost(b, None).alias("total_cost_usd"),
        (b.cast("double") / F.lit(PRICE_UNIT_BYTES)).alias("total_tib"),
    )


def cost_vs_baseline(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Current bytes per model with its baseline entry (NULL = new model)."""
    b = baseline.select(F.col("model"), F.col("bytes_processed").alias("baseline_bytes"))
    c = current.select(F.col("model"), F.col("bytes_processed").alias("current_bytes"))
    return c.join(b, "model", "left")


def cost_regression(current: DataFrame, baseline: DataFrame,
                    threshold_pct: float = REGRESSION_THRESHOLD_PCT) -> DataFrame:
    """Per model: increase over baseline and a status.

    ``unknown`` (no measurement) fails; ``new`` (no baseline) passes; a model
    with baseline > 0 fails when the increase is strictly above the threshold.
    """
    j = cost_vs_baseline(current, baseline)
    inc = F.when(
        F.col("baseline_bytes") > 0,
        (F.col("current_bytes") - F.col("baseline_bytes")).cast("double") / F.col("baseline_bytes") * 100,
    )
    status = (
        F.when(F.col("current_bytes").isNull(), F.lit("unknown"))
        .when(F.col("baseline_bytes").isNull(), F.lit("new"))
        .when(inc > threshold_pct, F.lit("fail"))
        .otherwise(F.lit("pass"))
    )
    return j.select(
        "model", "current_bytes", "baseline_bytes", F.round(inc, 4).alias("increase_pct"),
        shadow_cost(F.col("current_bytes")).alias("current_cost_usd"), status.alias("status"),
    ).withColumn("passed", F.col("status").isin("pass", "new"))


def regression_passed(report: DataFrame, baseline_empty_fails: bool = False) -> DataFrame:
    """One row: did every model pass (``bool_and``)?  Empty report passes unless told otherwise."""
    return report.agg(
        F.coalesce(F.bool_and("passed"), F.lit(not baseline_empty_fails)).alias("passed"),
        F.count(F.lit(1)).alias("models_checked"),
        F.sum(F.when(~F.col("passed"), 1).otherwise(0)).alias("models_failed"),
    )


def baseline_update(baseline: DataFrame, measured: DataFrame) -> DataFrame:
    """New baseline: measured entries overwrite, all other entries are kept."""
    m = measured.select("model", "bytes_processed", shadow_cost(F.col("bytes_processed")).alias("shadow_cost_usd"))
    keep = baseline.join(m.select("model"), "model", "left_anti")
    if "shadow_cost_usd" not in keep.columns:
        keep = keep.withColumn("shadow_cost_usd", shadow_cost(F.col("bytes_processed")))
    return keep.select("model", "bytes_processed", "shadow_cost_usd").unionByName(m)


BASELINE_ENTRY = StructType([StructField("bytes_processed", LongType()), StructField("shadow_cost_usd", DoubleType())])


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Baseline document(s) ``{model: {bytes_processed, shadow_cost_usd}}`` as rows; missing -> empty, unreadable -> error."""
    empty = spark.createDataFrame([], "model string, bytes_processed bigint, shadow_cost_usd double")
    try:
        docs = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty  # first run, every model is new
    m = F.from_json("value", MapType(StringType(), BASELINE_ENTRY), {"mode": "FAILFAST"})
    return docs.select(F.explode(m).alias("model", "e")).select(
        "model", "e.bytes_processed", "e.shadow_cost_usd")


def write_baseline(baseline: DataFrame, path: str) -> None:
    """Write the baseline as one JSON map document (one entry per model of the project)."""
    doc = baseline.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(
        "model", F.struct("bytes_processed", "shadow_cost_usd"))))).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)


def run_cost_gate(spark: SparkSession, current: DataFrame, baseline_path: str,
                  threshold_pct: float = REGRESSION_THRESHOLD_PCT, check_only: bool = False) -> DataFrame:
    """The cost-regression gate over a stored baseline; returns the one-row verdict.

    * the baseline document is read (missing -> empty: every model is new);
    * with ``check_only`` an empty baseline fails the gate (nothing to compare);
    * otherwise, and only when the gate passes, the measured models are merged
      into the baseline and it is written back (a failing run keeps the old one).
    The verdict is a small aggregate; the pass flag is read back as a scalar.
    """
    baseline = read_baseline(spark, baseline_path)
    empty = baseline.isEmpty()
    verdict = regression_passed(cost_regression(current, baseline, threshold_pct))
    # A one-row verdict, taken before any write (the baseline file may be replaced below).
    row = verdict.first()
    passed = bool(row.passed) and not (check_only and empty)
    if passed and not check_only:
        # The new document is built from the old one: cut the lineage
        # (reliable checkpoint) before overwriting the file it was read from.
        from seisma.session import checkpointed

        write_baseline(checkpointed(baseline_update(baseline, current)), baseline_path)
    return spark.createDataFrame([(passed, row.models_checked, row.models_failed)], verdict.schema)
