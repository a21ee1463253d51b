"""Landing zone: immutable raw-document archive and NDJSON staging files.

* ``archive_raw`` writes feed documents under
  ``source=S/year=Y/month=MM/day=DD/hour=HH`` (partitioned JSON lines) with a
  content hash.  What the archive holds is looked up in ``<archive>_digests``,
  a narrow Parquet table of whole digests partitioned by source and day.
* ``write_ndjson`` / ``load_ndjson`` are the staging hop: newline-delimited
  JSON, read back with an explicit schema in FAILFAST mode (a bad record
  fails the load instead of being dropped).
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from seisma.functions.hashing import document_digest, document_hash
from seisma.session import checkpointed, read_if_exists

ARCHIVE_SCHEMA = StructType([
    StructField("ingestion_time", TimestampType()),
    StructField("content_hash", StringType()),
    StructField("doc", StringType()),
    StructField("source", StringType()),
    StructField("year", StringType()),
    StructField("month", StringType()),
    StructField("day", StringType()),
    StructField("hour", StringType()),
])


def archive_columns(ingestion_time: Column) -> list[Column]:
    """Zero-padded UTC path parts of the archive layout."""
    return [
        F.date_format(ingestion_time, "yyyy").alias("year"),
        F.date_format(ingestion_time, "MM").alias("month"),
        F.date_format(ingestion_time, "dd").alias("day"),
        F.date_format(ingestion_time, "HH").alias("hour"),
    ]


def archive_raw(docs: DataFrame, path: str, source: str | Column = "source",
                ingestion_time: dt.datetime | Column = "ingestion_time") -> None:
    """Append documents (column ``doc``) to the partitioned archive; NULL documents are an error.

    A document that the archive has with the same source, ingestion time and content is not written
    again, so a replayed batch adds nothing.  Content means the whole digest; only the index
    partitions of the batch's own days are read.  The digests are noted as ``pending`` before the
    documents are written and as ``done`` after, so after a crash in between the replay looks into
    the archive's hours for the pending ones, and nothing is lost or doubled.
    """
    src = F.col(source) if isinstance(source, str) and source in docs.columns else (
        source if isinstance(source, Column) else F.lit(source))
    if isinstance(ingestion_time, str):
        ts = F.col(ingestion_time)
    elif isinstance(ingestion_time, Column):
        ts = ingestion_time
    else:
        ts = F.lit(ingestion_time).cast("timestamp")
    checked = F.when(F.col("doc").isNull(), F.raise_error(F.lit("archive_raw: document is NULL"))).otherwise(
        F.col("doc"))
    out = docs.select(
        ts.alias("ingestion_time"), document_hash(F.col("doc")).alias("content_hash"), checked.alias("doc"),
        src.alias("source"), *archive_columns(ts), document_digest(F.col("doc")).alias("_digest"),
    )
    spark = docs.sparkSession
    out = checkpointed(out.dropDuplicates(["source", "ingestion_time", "_digest"]))
    out = _not_archived(spark, out, path)
    if out.isEmpty():
        return
    note = out.select("ingestion_time", F.col("_digest").alias("digest"), "source", _at().alias("at"))
    index = digest_index_path(path)
    _note(note, index, "pending")
    parts = ("source", "year", "month", "day", "hour")
    # REBALANCE by the path columns: one file per hour where possible instead
    # of one per (task, hour); AQE splits an hour that holds a large share.
    out.drop("_digest").hint("rebalance", *parts).write.mode("append").partitionBy(*parts).json(path)
    _note(note, index, "done")


def digest_index_path(path: str) -> str:
    return f"{path.rstrip('/')}_digests"


def _at() -> Column:
    """Partition value of the index: the day of the archive's path."""
    return F.concat_ws("-", "year", "month", "day")


def _note(digests: DataFrame, index: str, state: str) -> None:
    digests.withColumn("state", F.lit(state)).hint("rebalance", "source", "at").write.mode("append").partitionBy("source", "at").parquet(index)


def _not_archived(spark: SparkSession, new: DataFrame, path: str) -> DataFrame:
    """Rows of ``new`` that the archive does not hold."""
    same = ["source", "ingestion_time", "_digest"]
    found = new.select("source", _at().alias("at")).distinct().collect()  # one row for each source and day of the batch
    noted = archived_digests(spark, path, [(r.source, r.at) for r in found])
    if noted is not None:
        noted = checkpointed(noted.select("source", "ingestion_time", F.col("digest").alias("_digest"), "state"))
        new = checkpointed(new.join(noted.where(F.col("state") == "done").select(*same), same, "left_anti").select(*new.columns))
        doubtful = new.join(noted.where(F.col("state") == "pending").select(*same), same, "left_semi")
    else:
        doubtful = new  # an archive from before the index, or none at all
    have = archive_if_exists(spark, path)
    if have is None or doubtful.isEmpty():
        return new
    parts = F.concat_ws("-", "source", "year", "month", "day", "hour")  # path columns only: other folders are pruned
    hours = [r[0] for r in doubtful.select(parts).distinct().collect()]
    there = have.where(parts.isin(hours)).select("source", "ingestion_time", document_digest("doc").alias("_digest"))
    return checkpointed(new.join(there.distinct(), same, "left_anti").select(*new.columns))


def archived_digests(spark: SparkSession, path: str, days: list[tuple[str, str]]) -> DataFrame | None:
    """Noted digests of the given (source, ``yyyy-MM-dd``) partitions; None where there is no index."""
    if read_if_exists(spark, digest_index_path(path)) is None:
        return None
    schema = "ingestion_time timestamp, digest string, state string, source string, at string"
    return spark.read.schema(schema).parquet(digest_index_path(path)).where(
        F.col("source").isin(sorted({s for s, _ in days})) & F.col("at").isin(sorted({d for _, d in days})))


def archive_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_archive(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archive back with partition columns as (zero-padded) text."""
    return spark.read.schema(ARCHIVE_SCHEMA).option("basePath", path).json(path)


def write_ndjson(rows: DataFrame, path: str) -> None:
    """Staging rows as NDJSON; an empty batch is an error (nothing to load)."""
    if rows.isEmpty():
        raise ValueError("write_ndjson: no rows to stage")
    rows.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def load_ndjson(spark: SparkSession, path: str, schema: StructType, observation=None) -> DataFrame:
    """Read NDJSON with an explicit schema; any malformed record fails the read.

    Pass a ``pyspark.sql.Observation`` to get the loaded row count
    (``observation.get["rows"]``) from the same pass that consumes the data.
    """
    df = (
        spark.read.schema(schema).option("mode", "FAILFAST")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    )
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    return df
