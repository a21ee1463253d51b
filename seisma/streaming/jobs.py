"""Structured Streaming forms of the ingest, hourly-count and matching jobs.

* ``stream_ingest``: landing files -> ``foreachBatch`` MERGE into the
  day-partitioned raw table (partition-wise rewrite, idempotent: a replayed
  micro-batch changes nothing, so exactly-once output follows from the
  checkpointed source offsets).  Empty micro-batches exit early.
* ``stream_hourly_counts``: watermarked tumbling 1-hour windows in update
  mode, upserted into a day-partitioned counts table per micro-batch.
* ``stream_candidates``: stream-stream inner join on the matcher's blocking
  key with watermarks on its time bucket on both sides (bounded state), as pairs or, where they
  are many, as packed rows (``seisma.operators.packs``); ranking windows are not allowed on streams, so mutual-best runs
  over the landed candidates in batch (``seisma.operators.matching``) or per
  micro-batch over the neighbourhood of its pairs (``stream_matches``).
* ``route_late`` parts off the rows that a watermark would drop without a word.

Checkpoints always live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from seisma.operators.dedup import dedup_latest
from seisma.operators.matching import DEFAULT, MatchConfig, home, mutual_best, pair_columns, reach_keys, usable, within
from seisma.operators.packs import packed, unpacked
from seisma.operators.sinks import write_days
from seisma.operators.snapshots import DayTable, in_days
from seisma.operators.upsert import merge_stored, upsert
from seisma.session import checkpointed, ensure_utc, read_if_exists, scratch_path
from seisma.sources.schemas import SourceSpec


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def stream_ingest(spark: SparkSession, landing: str, schema: StructType, spec: SourceSpec, target: str | DayTable,
                  checkpoint: str | None = None, trigger: str | None = "availableNow",
                  max_files_per_trigger: int | None = None, date_col: str = "event_date") -> StreamingQuery:
    """Raw feed rows landing as NDJSON -> MERGE into ``target`` once per micro-batch."""
    ensure_utc(spark)
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.json(landing)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # nothing fetched: write nothing
            return
        merge_stored(batch.sparkSession, target, batch, spec, **({} if isinstance(target, DayTable) else {"date_col": date_col}))

    w = src.writeStream.foreachBatch(apply).option(
        "checkpointLocation", checkpoint or scratch_path(spark, f"ckpt-ingest-{spec.name}"))
    return _trigger(w, trigger).start()


def stream_hourly_counts(spark: SparkSession, events: DataFrame, ts: str, target: str,
                         delay: str = "1 hour", checkpoint: str | None = None,
                         trigger: str | None = "availableNow") -> StreamingQuery:
    """Hourly event counts of a streaming DataFrame, upserted into a table per micro-batch.

    Update mode emits the running count of every window touched by a batch;
    the watermark (``delay``) bounds the window state.  Each emitted row
    replaces the stored row of its hour (version = batch id, strictly newer).
    """
    counts = (
        events.withWatermark(ts, delay)
        .groupBy(F.window(F.col(ts), "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("w.start").alias("hour_bucket"), "event_count")
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn(
            "event_date", F.to_date("hour_bucket"))
        s = batch.sparkSession
        cur = read_if_exists(s, target)
        if cur is None:  # first batch: no table yet
            write_days(rows, target, "event_date", cluster_by=None, overwrite_all=True)
            return
        # Spark broadcasts the day list when it is small; otherwise the join shuffles
        days = rows.select("event_date").distinct()
        touched = cur.join(days, "event_date", "left_semi")
        cols = ["hour_bucket", "event_count", "batch_id"]
        merged = upsert(touched.select(*cols), rows.select(*cols), "hour_bucket", "batch_id", keep_on_update=())
        merged = checkpointed(merged.withColumn("event_date", F.to_date("hour_bucket")))
        write_days(merged, target, "event_date", cluster_by=None)

    w = counts.writeStream.outputMode("update").foreachBatch(apply).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "ckpt-hourly"))
    return _trigger(w, trigger).start()


def stream_candidates(left: DataFrame, right: DataFrame, cfg: MatchConfig = DEFAULT,
                      delay: str = "10 minutes", packs: bool = False) -> DataFrame:
    """Streaming candidate pairs: stream-stream equi-join on (start of the time bucket, lat cell, lon cell).

    Both inputs are streaming DataFrames with the matcher's event columns.  The
    watermarks stand on the bucket's start, which is a join key, so Spark drops a whole
    bucket once no row of it can come any more, and a pair is tested by its thresholds alone.
    A bucket a row is copied to may start up to the matcher's seconds and a bucket before
    the row, or those seconds after it: the watermarks wait so much longer than ``delay``.

    With ``packs`` the events of a block are packed before the join, by day on the left, and it gives packed
    rows: state, join and landing grow as the events, however many pairs they make; ``unpacked`` gives the pairs.
    """
    l, r = cfg.left, cfg.right
    width = cfg.time_bucket_seconds
    L = home(usable(left, l), l, cfg, "_ltb", "_llc", "_lgc")
    R = reach_keys(usable(right, r), r, cfg, "_rtb", "_rlc", "_rgc")
    later = f"{delay} {2 * (cfg.max_seconds + 1) + width} seconds"
    L, R = (df.withColumn(start, F.timestamp_micros(F.col(tb) * (width * 1_000_000))).drop(tb)
            for df, tb, start in ((L, "_ltb", "_lstart"), (R, "_rtb", "_rstart")))
    if packs:
        L = packed(L.withColumn("_day", F.to_date(f"{l}_time")), ["_lstart", "_llc", "_lgc", "_day"], l)
        R = packed(R, ["_rstart", "_rlc", "_rgc"], r)
    L, R = L.withWatermark("_lstart", later), R.withWatermark("_rstart", later)
    same = (F.col("_lstart") == F.col("_rstart")) & (F.col("_llc") == F.col("_rlc")) & (F.col("_lgc") == F.col("_rgc"))
    if packs:
        return L.join(R, same, "inner").drop("_rstart", "_rlc", "_rgc")
    return L.join(R, same & within(cfg), "inner").select(*pair_columns(cfg))


def land_candidates(spark: SparkSession, cands: DataFrame, path: str, checkpoint: str | None = None,
                    trigger: str | None = "availableNow") -> StreamingQuery:
    """Append streaming candidate pairs, or packed rows, to a Parquet table (append mode, file sink)."""
    w = cands.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "ckpt-candidates"))
    return _trigger(w, trigger).start()


def run_to_end(q: StreamingQuery, timeout: dt.timedelta = dt.timedelta(minutes=30)) -> None:
    """Wait for an ``availableNow`` query; surface its failure."""
    q.awaitTermination(timeout.total_seconds())
    if q.isActive:
        q.stop()
        raise TimeoutError("streaming query did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_ingest_docs(spark: SparkSession, landing: str, source: str, target: str | DayTable, archive: str | None = None,
                       checkpoint: str | None = None, trigger: str | None = "availableNow",
                       max_files_per_trigger: int | None = None, clock=None) -> StreamingQuery:
    """Feed documents landing as text lines (one document per line) -> one ingest run per micro-batch.

    Each micro-batch is parsed, stamped with one batch id and time, archived
    and MERGEd (``seisma.plans.ingest.ingest_batch``).  The stamp is the source,
    the checkpoint folder's name and the batch id; the MERGE only takes strictly
    newer versions and the archive skips what it has, so a replayed micro-batch
    leaves both unchanged.  The ingestion time is the newest landing time of the
    batch's files, or what ``clock`` says for the batch id.
    """
    from seisma.plans.ingest import ingest_batch

    ensure_utc(spark)
    checkpoint = checkpoint or scratch_path(spark, f"ckpt-docs-{source}")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.text(landing).select(F.col("value").alias("doc"), F.col("_metadata.file_modification_time").alias("_landed"))

    query_name = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        s = batch.sparkSession
        stamp = f"{source}-{query_name}-{batch_id:08d}"
        at = clock(batch_id) if clock else batch.agg(F.max("_landed")).first()[0]
        ingest_batch(s, batch.select("doc"), source, target, stamp, at, archive=archive).collect()

    w = src.writeStream.foreachBatch(apply).option(
        "checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def update_matches(batch: DataFrame, batch_id: int, cands: DayTable, matches: DayTable, cfg: MatchConfig = DEFAULT) -> int:
    """Bring the mutual-best matches up to date with a batch of candidate pairs; returns the number of days read.

    ``cands`` holds one row a pair (that of the newest batch), ``matches`` the mutual pairs, both by the
    day of the left event.  The best partner can only change for events that stand in a pair of the
    batch, so only verdicts on pairs of those events are replaced; partners lie within the matcher's
    seconds, so the batch's days and their neighbours are all that is read and written, however long
    the history.  A batch's pairs are written once, straight into the candidates' folder; days that
    held pairs before are written again.  A repeated batch leaves both tables as they are.  A pair is replaced
    when it comes again; one whose event moved to another day stays until its own day sees it again.
    A batch of packed rows (``stream_candidates`` with ``packs``) does the same with ``cands`` in packed form.
    """
    if f"{cfg.left}_pack" in batch.columns:
        return _update_by_packs(batch, batch_id, cands, matches, cfg)
    l, r = f"{cfg.left}_id", f"{cfg.right}_id"
    columns, day = [c for c in batch.columns if c not in ("batch_id", cands.date_col)], cands.date_col
    rows = batch.select(*columns).withColumn("batch_id", F.lit(batch_id).cast("bigint")).withColumn(day, F.to_date(f"{cfg.left}_time"))
    commit, new = cands.stage(rows)  # the stream's join runs once
    spark = new.sparkSession
    times = [(a, b) for a, b in new.select(day, F.to_date(f"{cfg.right}_time")).distinct().collect()]  # calendar days
    if not times:  # no pairs: commit nothing
        return 0
    found = {a for a, _ in times}
    # partners of either event of a pair, a day away at most
    near = {d for t in times for x in t for d in (x - dt.timedelta(days=1), x, x + dt.timedelta(days=1))}
    version, base = cands.version(), matches.version()
    held = near & set(cands.days(version)) if version is not None else set()
    pairs = cands.read(version, held).unionByName(new) if held else new

    # pairs that stand twice are told by their hashes, so that only those rows are sorted and compared
    key = F.xxhash64(l, r)
    again = pairs.groupBy(key.alias("_pair")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_pair")
    again = _written(again, "pairs-again")
    moved = set()
    if not again.isEmpty():
        order = [F.col("batch_id").desc(), *[F.col(c).asc_nulls_last() for c in columns]]
        keyed = pairs.withColumn("_pair", key)
        twice = _written(keyed.join(again, "_pair", "left_semi").select(*pairs.columns), "pairs-twice")
        moved = {d[0] for d in twice.select(day).distinct().collect()}  # calendar days
        pairs = keyed.join(again, "_pair", "left_anti").select(*pairs.columns).unionByName(
            _written(dedup_latest(twice, [l, r], order), "pairs-newest"))

    # all pairs of the days around stand here, so every verdict on a pair of a changed event is whole
    after = _renewed(mutual_best(pairs.select(*columns), cfg), [new.select(c) for c in (l, r)], matches, base, near, bool(held), cfg)

    # only days that had pairs before, or pairs twice, are written again; others are committed as staged
    mixed = (found & held) | moved
    stored = pairs.select(*columns, "batch_id", day)
    cands.replace(stored.where(in_days(day, mixed)) if mixed else None, mixed, version, {"batch_id": batch_id}, (commit, found - mixed), stored.schema)
    matches.replace(after, found | near, base, {"batch_id": batch_id})
    return len(near)


def _renewed(now: DataFrame, changed: list[DataFrame], matches: DayTable, base: int | None, near: set[dt.date], old_pairs: bool, cfg: MatchConfig) -> DataFrame:
    """The matches of the days ``near``, by day: those of ``now`` on the changed events, and the kept ones of others.

    ``changed`` gives the ids of the left and the right events; without pairs or matches of before, all of ``now`` are new.
    """
    l, r, day, columns = f"{cfg.left}_id", f"{cfg.right}_id", matches.date_col, now.columns
    near_matches = near & set(matches.days(base)) if base is not None else set()
    if old_pairs or near_matches:
        changed_l, changed_r = (_written(ids.distinct(), "changed") for ids in changed)
        marked = now.join(changed_l.withColumn("_l", F.lit(True)), l, "left").join(changed_r.withColumn("_r", F.lit(True)), r, "left")
        now = marked.where(F.col("_l").isNotNull() | F.col("_r").isNotNull())
    after = now.withColumn(day, F.to_date(f"{cfg.left}_time")).select(*columns, day)
    if near_matches:
        kept = matches.read(base, near_matches).join(changed_l, l, "left_anti").join(changed_r, r, "left_anti")
        after = kept.select(*columns, day).unionByName(after)
    return after


def _update_by_packs(batch: DataFrame, batch_id: int, cands: DayTable, matches: DayTable, cfg: MatchConfig) -> int:
    """``update_matches`` for packed rows; ``cands`` keeps them as they came, with their batch, so it grows as the events.

    A repeated batch replaces its rows of the first time.
    """
    l, r, day = f"{cfg.left}_id", f"{cfg.right}_id", cands.date_col
    commit, new = cands.stage(batch.withColumnRenamed("_day", day).withColumn("batch_id", F.lit(batch_id).cast("bigint")))
    on = F.array_distinct(F.transform(f"{cfg.right}_time", lambda t: F.to_date(F.timestamp_micros(t))))
    times = [(a, b) for a, b in new.select(day, F.explode(on)).distinct().collect()]  # calendar days
    if not times:  # no events met: commit nothing
        return 0
    found = {a for a, _ in times}
    near = {d for t in times for x in t for d in (x - dt.timedelta(days=1), x, x + dt.timedelta(days=1))}
    version, base = cands.version(), matches.version()
    held = near & set(cands.days(version)) if version is not None else set()
    packs = cands.read(version, held).where(F.col("batch_id") != batch_id).unionByName(new) if held else new

    now = mutual_best(_newest_pairs(packs, cfg), cfg)
    after = _renewed(now, [new.select(F.explode(c).alias(c)) for c in (l, r)], matches, base, near, bool(held), cfg)
    mixed = found & held
    cands.replace(packs.where(in_days(day, mixed)) if mixed else None, mixed, version, {"batch_id": batch_id}, (commit, found - mixed), new.schema)
    matches.replace(after, found | near, base, {"batch_id": batch_id})
    return len(near)


def _newest_pairs(packs: DataFrame, cfg: MatchConfig) -> DataFrame:
    """The pairs of packed rows, each as its newest batch has it; of rows without repeated events only those that can win.

    A pair stands twice only where its left event came twice, or its right event twice to one block: rows
    with such events are unpacked whole, and of their pairs the newest are taken.
    """
    l, r = f"{cfg.left}_id", f"{cfg.right}_id"

    def again(pack: str, ids: str, by: tuple[str, ...] = ()) -> DataFrame | None:
        """The packs with events that came more than once."""
        rows = packs.select(pack, *by, F.posexplode(ids).alias("_place", "_id"))
        rows = rows.select(pack, F.xxhash64("_id", *by).alias("_event"), F.xxhash64(pack, "_place").alias("_arrival"))
        more = rows.groupBy("_event").agg(F.min("_arrival").alias("_a"), F.max("_arrival").alias("_b")).where("_a <> _b").select("_event")
        more = _written(more, "events-again")
        return None if more.isEmpty() else _written(rows.join(more, "_event", "left_semi").select(pack).distinct(), "packs-again")

    twice = {pack: found for pack, ids, by in ((f"{cfg.left}_pack", l, ()), (f"{cfg.right}_pack", r, ("_lstart", "_llc", "_lgc")))
             if (found := again(pack, ids, by)) is not None}
    if not twice:
        return unpacked(packs, cfg, nearest=True)
    marked = packs.withColumn("_twice", F.lit(False))
    for pack, found in twice.items():
        marked = marked.join(found.withColumn("_again", F.lit(True)), pack, "left").withColumn(
            "_twice", F.col("_twice") | F.col("_again").isNotNull()).drop("_again")
    pairs = _written(unpacked(marked.where("_twice"), cfg, keep=("batch_id",)), "pairs-twice")
    columns = [c for c in pairs.columns if c != "batch_id"]
    order = [F.col("batch_id").desc(), *[F.col(c).asc_nulls_last() for c in columns]]
    newest = _written(dedup_latest(pairs, [l, r], order).select(*columns), "pairs-newest")
    return unpacked(marked.where("NOT _twice"), cfg, nearest=True).unionByName(newest)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its size is known, so a small one is broadcast."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stream_matches(spark: SparkSession, cands: DataFrame, stored: DayTable, matches: DayTable, cfg: MatchConfig = DEFAULT,
                   checkpoint: str | None = None, trigger: str | None = "availableNow") -> StreamingQuery:
    """Keep a mutual-best matches table current while candidate pairs stream in (``update_matches`` per micro-batch)."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        update_matches(batch, batch_id, stored, matches, cfg)

    w = cands.writeStream.foreachBatch(apply).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "ckpt-matches"))
    return _trigger(w, trigger).start()


# --- late rows ----------------------------------------------------------------------


def route_late(spark: SparkSession, events: DataFrame, ts: str, delay: str, root: str, checkpoint: str | None = None,
               trigger: str | None = "availableNow") -> StreamingQuery:
    """Part a stream into rows within ``delay`` of the newest event seen before their micro-batch, and late ones.

    ``<root>/on_time/batch=<id>`` feeds the stateful queries: read in order with a watermark of the
    same delay (or a longer one), no row of it is behind the watermark, so Spark drops none unseen.
    ``<root>/late/batch=<id>`` keeps the others with the limit they missed, for ``late_rows`` and a
    replay.  The newest event time is kept by batch id, so a repeated micro-batch parts its rows as
    before; rows without a time are late.
    """
    ensure_utc(spark)
    root = root.rstrip("/")
    seen = f"{root}/seen"

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        s = batch.sparkSession
        batch = checkpointed(batch)
        before = read_if_exists(s, seen)
        newest = None if before is None else before.where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        limit = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        punctual = F.col(ts).isNotNull() & F.coalesce(F.col(ts) >= limit, F.lit(newest is None))
        batch.where(~punctual).withColumn("missed", limit).write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
        batch.agg(F.max(ts).alias("newest")).write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
        batch.where(punctual).write.mode("overwrite").parquet(f"{root}/on_time/batch={batch_id}")

    w = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-late"))
    return _trigger(w, trigger).start()


def on_time_rows(spark: SparkSession, root: str, schema: StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """The punctual rows as a stream, in the order in which they came."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{root.rstrip('/')}/on_time/*")


def late_rows(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """All rows that came too late so far, with ``missed`` (the limit they were behind) and their batch."""
    return spark.read.schema(StructType([*schema.fields, StructField("missed", TimestampType()), StructField("batch", LongType())])).parquet(f"{root.rstrip('/')}/late")


def add_late_counts(spark: SparkSession, late: DataFrame, ts: str, target: str) -> None:
    """Replay late rows into a table of hourly counts: once, by the batches already added for each hour.

    Each hour's row carries the number of the last late batch added to it, so a repeated replay adds nothing.
    """
    cur = spark.read.parquet(target)
    if "late_batch" not in cur.columns:
        cur = cur.withColumn("late_batch", F.lit(-1).cast("bigint"))
    cur = checkpointed(cur)
    late = late.where(F.col(ts).isNotNull()).withColumn("hour_bucket", F.date_trunc("HOUR", F.col(ts)))
    done = cur.select("hour_bucket", F.col("late_batch").alias("_done"))
    fresh = late.join(done, "hour_bucket", "left").where(F.col("batch") > F.coalesce("_done", F.lit(-1)))
    more = fresh.groupBy("hour_bucket").agg(F.count(F.lit(1)).alias("_more"), F.max("batch").alias("_last"))
    out = cur.join(more, "hour_bucket", "full").select(
        "hour_bucket", (F.coalesce("event_count", F.lit(0)) + F.coalesce("_more", F.lit(0))).alias("event_count"),
        F.coalesce("batch_id", F.lit(-1)).cast("bigint").alias("batch_id"), F.greatest("late_batch", "_last").alias("late_batch"),
        F.to_date("hour_bucket").alias("event_date"))
    write_days(checkpointed(out), target, "event_date", cluster_by=None, overwrite_all=True)
