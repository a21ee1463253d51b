"""One ingest run per feed, as a function instead of an HTTP endpoint.

parse documents -> stamp the batch (one id, one time) -> archive the raw
documents -> MERGE into the day-partitioned raw table.  Returns the
endpoint's answer as a one-row DataFrame:
``(status, source, ingestion_id, events_processed, rows_merged)``.
An empty batch writes nothing, the archive neither, and reports 0 / 0; a document that
is no JSON fails the run before anything is written.  Items whose time does not parse
take no part in the counts; they go to the quarantine with their reason, once however
often the documents are replayed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from seisma.operators.snapshots import DayTable
from seisma.operators.upsert import merge_stored, quarantine_rows
from seisma.session import checkpointed, ensure_utc
from seisma.sources.feeds import PARSERS, split_rejects, to_raw
from seisma.sources.landing import archive_raw
from seisma.sources.schemas import spec_for


def ingest_batch(spark: SparkSession, docs: DataFrame, source: str, target: str | DayTable, ingestion_id: str,
                 ingestion_time: dt.datetime, archive: str | None = None) -> DataFrame:
    ensure_utc(spark)
    spec = spec_for(source)  # unknown source -> ValueError, as the endpoint's 4xx/5xx
    root = target.root if isinstance(target, DayTable) else target.rstrip("/")
    if source == "usgs":  # a missing time is a row of its own there, which the merge quarantines
        events = checkpointed(PARSERS[source](docs))
    else:
        events, rejects = split_rejects(checkpointed(PARSERS[source](docs, keep_rejects=True)))
        quarantine_rows(rejects, f"{root}_rejected_items")
    n_events = events.count()  # a scalar, like the endpoint's JSON answer
    rows_merged = 0
    if n_events:
        if archive is not None:
            archive_raw(docs.select("doc"), archive, source=source, ingestion_time=ingestion_time)
        rows = to_raw(events, spec, ingestion_id, ingestion_time)
        rows_merged = merge_stored(spark, target, rows, spec).first().rows_affected
    return spark.createDataFrame(
        [("ok", source, ingestion_id, n_events, rows_merged)],
        "status string, source string, ingestion_id string, events_processed bigint, rows_merged bigint",
    )
