"""Idempotent upsert (MERGE) of a feed batch into its raw table.

Semantics of the reference MERGE: match on the key; update a matched row only
when the batch version is *strictly* newer (NULL on either side: no update);
insert unmatched batch rows whole; columns in ``keep_on_update`` (raw_json)
keep the first-seen value on update.  Re-applying a batch changes nothing.

``upsert`` is the pure DataFrame form.  ``merge_into_days`` applies it to a
day-partitioned Parquet table and rewrites only the days the batch touches
(the old day of every updated key and the day of every batch row), so the
cost per batch is proportional to the touched days, not to the whole table.
``merge_snapshot`` does the same on a ``DayTable``: the changed days become a
new version in one step, and a batch that changes nothing commits nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seisma.operators.dedup import dedup_latest
from seisma.operators.sinks import write_days
from seisma.operators.snapshots import DayTable, in_days
from seisma.session import checkpointed, read_if_exists
from seisma.sources.schemas import SourceSpec


def dedup_batch(batch: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key in a batch (newest version, then latest ingestion).

    A MERGE with two source rows for one target row is an error; a join would
    fan out instead, so batches are deduplicated first.
    """
    order = [F.col(version).desc_nulls_last()]
    if "ingestion_time" in batch.columns:
        order.append(F.col("ingestion_time").desc_nulls_last())
    order.append(F.col("raw_json").asc_nulls_last() if "raw_json" in batch.columns else F.col(key).asc())
    return dedup_latest(batch, [key], order)


def upsert_actions(target: DataFrame, batch: DataFrame, key: str, version: str) -> DataFrame:
    """Full outer join of target and batch with an ``_action`` per key: insert / update / keep."""
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns])
    s = batch.select(*[F.col(c).alias(f"s__{c}") for c in batch.columns])
    j = t.join(s, F.col(f"t__{key}") == F.col(f"s__{key}"), "full_outer")
    newer = F.coalesce(F.col(f"s__{version}") > F.col(f"t__{version}"), F.lit(False))
    action = (
        F.when(F.col(f"t__{key}").isNull(), F.lit("insert"))
        .when(F.col(f"s__{key}").isNotNull() & newer, F.lit("update"))
        .otherwise(F.lit("keep"))
    )
    return j.withColumn("_action", action)


def upsert(target: DataFrame, batch: DataFrame, key: str, version: str,
           keep_on_update: Sequence[str] = ("raw_json",), dedup: bool = True) -> DataFrame:
    """New target after MERGE (column layout of ``target``)."""
    return upsert_tagged(target, batch, key, version, keep_on_update, dedup).drop("_action")


def upsert_tagged(target: DataFrame, batch: DataFrame, key: str, version: str,
                  keep_on_update: Sequence[str] = ("raw_json",), dedup: bool = True) -> DataFrame:
    """``upsert`` plus the ``_action`` (insert / update / keep) that produced each row."""
    if dedup:
        batch = dedup_batch(batch, key, version)
    a = upsert_actions(target, batch, key, version)
    act = F.col("_action")
    cols = []
    for c in target.columns:
        t, s = F.col(f"t__{c}"), F.col(f"s__{c}")
        if c == key or c in keep_on_update:
            cols.append(F.when(act == "insert", s).otherwise(t).alias(c))
        else:
            cols.append(F.when(act.isin("insert", "update"), s).otherwise(t).alias(c))
    return a.select(*cols, act)


def upsert_counts(target: DataFrame, batch: DataFrame, key: str, version: str, dedup: bool = True) -> DataFrame:
    """Rows inserted / updated / deleted and their sum (the MERGE's affected count), one row.

    Only batch rows can be affected, so this is ``batch LEFT JOIN target``
    on the key with the target pruned to (key, version).
    """
    if dedup:
        batch = dedup_batch(batch, key, version)
    t = target.select(F.col(key).alias("_tk"), F.col(version).alias("_tv"))
    j = batch.select(key, version).join(t, F.col(key) == F.col("_tk"), "left")
    ins = F.col("_tk").isNull()
    upd = F.col("_tk").isNotNull() & F.coalesce(F.col(version) > F.col("_tv"), F.lit(False))
    return j.agg(
        F.sum(F.when(ins, 1).otherwise(0)).cast("bigint").alias("rows_inserted"),
        F.sum(F.when(upd, 1).otherwise(0)).cast("bigint").alias("rows_updated"),
        F.lit(0).cast("bigint").alias("rows_deleted"),
    ).select(
        F.coalesce("rows_inserted", F.lit(0).cast("bigint")).alias("rows_inserted"),
        F.coalesce("rows_updated", F.lit(0).cast("bigint")).alias("rows_updated"),
        "rows_deleted",
    ).withColumn("rows_affected", F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_deleted"))


def merge_spec(target: DataFrame, batch: DataFrame, spec: SourceSpec) -> DataFrame:
    return upsert(target, batch, spec.key, spec.version, spec.keep_on_update)


def split_required(batch: DataFrame, spec: SourceSpec) -> tuple[DataFrame, DataFrame]:
    """(rows that can be stored, rows without a key or an event time).

    The raw tables require both; an empty key would let unrelated events replace each other.
    """
    ok = F.col(spec.key).isNotNull() & (F.trim(F.col(spec.key).cast("string")) != "") & F.col(spec.time_col).isNotNull()
    return batch.where(ok), batch.where(~F.coalesce(ok, F.lit(False)))


def quarantine_rows(rows: DataFrame, path: str) -> None:
    """Append ``rows`` to the table at ``path``, leaving out rows that are there already (a replay adds none)."""
    marked = rows.withColumn("reject_id", F.sha2(F.to_json(F.struct(*rows.columns)), 256)).dropDuplicates(["reject_id"])
    have = read_if_exists(rows.sparkSession, path)
    new = checkpointed(marked if have is None else marked.join(have.select("reject_id"), "reject_id", "left_anti").select(*marked.columns))
    if not new.isEmpty():
        new.write.mode("append").parquet(path)


def merge_into_days(spark: SparkSession, path: str, batch: DataFrame, spec: SourceSpec,
                    date_col: str = "event_date", quarantine: str | None = None) -> DataFrame:
    """MERGE ``batch`` into the day-partitioned raw table at ``path``; returns the counts row.

    1. batch rows without key or time go to ``quarantine`` (default: ``<path>_rejected``), the
       others are deduplicated to one row per key;
    2. touched days = the days of target rows whose key is in the batch (a
       semi join against the table's key and day columns only) plus the batch
       rows' own days (an update can move an event to another day); the NULL
       day of old rows without a time is one of them when such a row is hit;
    3. rebuild only those days (static partition pruning) and overwrite them
       dynamically.  Insert / update counts come from the same merge.

    A run that died between the overwrite and the clearing of days that lost
    all their rows leaves a key in two days; the next run that touches the key
    reads both days and keeps its newest row, so repeating the batch heals the table.

    The day list is one entry per calendar day, so it is small and bounded.
    The rebuilt days are checkpointed before the overwrite, because a job must
    not overwrite the files it is reading.
    """
    key = spec.key
    root = path.rstrip("/")
    good, bad = split_required(batch, spec)
    quarantine_rows(bad, quarantine or f"{root}_rejected")
    batch = checkpointed(dedup_batch(good, key, spec.version).withColumn(date_col, F.to_date(spec.time_col)))
    target = spark.read.parquet(path)
    hit = target.select(key, date_col).join(batch.select(key), key, "left_semi").select(date_col)
    days = [r[0] for r in hit.unionByName(batch.select(date_col)).distinct().collect()]  # calendar days

    cols = [c for c in target.columns if c != date_col]
    merged = _rebuilt(target.where(in_days(date_col, days)), batch, spec, date_col)
    counts = _counts(merged)

    # Dynamic overwrite replaces only days present in the output; a touched
    # day whose every row moved to another day is overwritten with no rows.
    kept = {r[0] for r in merged.select(date_col).distinct().collect()}
    write_days(merged.drop("_action"), path, date_col, cluster_by=None)
    nothing = merged.select(*cols).limit(0).coalesce(1)
    for d in days:
        if d not in kept:
            name = "__HIVE_DEFAULT_PARTITION__" if d is None else d.isoformat()
            nothing.write.mode("overwrite").parquet(f"{root}/{date_col}={name}")
    return counts


def _rebuilt(affected: DataFrame, batch: DataFrame, spec: SourceSpec, date_col: str) -> DataFrame:
    """All rows of the affected days after the merge, with ``_action`` and their day, computed once."""
    key, cols = spec.key, [c for c in affected.columns if c != date_col]
    affected = affected.select(*cols)
    keyless = affected.where(F.col(key).isNull())  # takes no part in the merge, but its day is rewritten
    affected = dedup_batch(affected.where(F.col(key).isNotNull()), key, spec.version)
    merged = upsert_tagged(affected, batch.select(*cols), key, spec.version, spec.keep_on_update, dedup=False)
    merged = merged.unionByName(keyless.withColumn("_action", F.lit("keep")))
    return checkpointed(merged.withColumn(date_col, F.to_date(spec.time_col)))


def _counts(merged: DataFrame) -> DataFrame:
    act = F.col("_action")
    return merged.agg(
        F.sum(F.when(act == "insert", 1).otherwise(0)).cast("bigint").alias("rows_inserted"),
        F.sum(F.when(act == "update", 1).otherwise(0)).cast("bigint").alias("rows_updated"),
    ).select(
        F.coalesce("rows_inserted", F.lit(0).cast("bigint")).alias("rows_inserted"),
        F.coalesce("rows_updated", F.lit(0).cast("bigint")).alias("rows_updated"),
        F.lit(0).cast("bigint").alias("rows_deleted"),
    ).withColumn("rows_affected", F.col("rows_inserted") + F.col("rows_updated"))


def merge_snapshot(table: DayTable, batch: DataFrame, spec: SourceSpec, quarantine: str | None = None,
                   note: dict | None = None) -> DataFrame:
    """MERGE ``batch`` into a snapshot table; returns the counts row.

    As ``merge_into_days``, but the days that really change (the days of inserted and updated rows,
    and the days those keys left) are written beside the old ones and become visible together.  The
    table before the merge stays readable by its version.  A writer that came first makes this one
    raise ``SnapshotConflict``; repeating the batch is then right, as it is after any crash.
    """
    key, day = spec.key, table.date_col
    good, bad = split_required(batch, spec)
    quarantine_rows(bad, quarantine or f"{table.root}_rejected")
    batch = checkpointed(dedup_batch(good, key, spec.version).withColumn(day, F.to_date(spec.time_col)))
    base = table.version()
    if base is None:
        first = batch.select(*spec.raw_names, day)
        table.create(first, note)
        return _counts(first.withColumn("_action", F.lit("insert")))
    hit = checkpointed(table.read(base).select(key, day).join(batch.select(key), key, "left_semi"))  # at most a row for each batch key
    days = [r[0] for r in hit.select(day).unionByName(batch.select(day)).distinct().collect()]  # calendar days
    merged = _rebuilt(table.read(base, days), batch, spec, day)
    changed = merged.where(F.col("_action") != "keep").select(key, day)
    left = hit.join(changed.select(key), key, "left_semi").select(day)
    touched = [r[0] for r in changed.select(day).unionByName(left).distinct().collect()]
    if touched:
        table.replace(merged.where(in_days(day, touched)).drop("_action"), touched, base, note)
    return _counts(merged)


def merge_stored(spark: SparkSession, target: str | DayTable, batch: DataFrame, spec: SourceSpec, **options) -> DataFrame:
    """MERGE into a snapshot table, or into the day-partitioned table at a path."""
    if isinstance(target, DayTable):
        return merge_snapshot(target, batch, spec, **options)
    return merge_into_days(spark, target, batch, spec, **options)
