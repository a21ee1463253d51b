"""Unified event table: one row per real-world event with canonical values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seisma.functions.geo import REGION_BOX, Box, in_box
from seisma.operators.matching import DEFAULT, MatchConfig


def unified_columns(cfg: MatchConfig = DEFAULT) -> list[str]:
    l, r = cfg.left, cfg.right
    return [
        "match_status", f"{l}_id", f"{r}_id", f"{l}_mag", f"{r}_mag", f"{l}_place", f"{r}_place",
        "unified_id", "event_time", "canonical_lat", "canonical_lon", "canonical_mag", "mag_disagreement",
        "time_diff_seconds", "distance_km", "sources_available", "processed_at",
    ]


def region_flag(cfg: MatchConfig = DEFAULT, box: Box = REGION_BOX) -> Column:
    """Event lies in the local agency's region, judged on local-first coordinates."""
    l, r = cfg.left, cfg.right
    return in_box(F.coalesce(F.col(f"{r}_lat"), F.col(f"{l}_lat")), F.coalesce(F.col(f"{r}_lon"), F.col(f"{l}_lon")), box)


def unify_events(matches: DataFrame, processed_at: dt.datetime, cfg: MatchConfig = DEFAULT,
                 box: Box = REGION_BOX) -> DataFrame:
    """Canonical columns over the matcher output.

    In the region the right-hand (local) source wins coordinates, and, for
    matched events only, magnitude and id; elsewhere the left source wins.
    Event time is always left-first.  ``processed_at`` is an explicit clock.
    """
    l, r = cfg.left, cfg.right
    c = F.col
    status = c("match_status")
    matched = status == "matched"
    # One named helper column; codegen evaluates it once per row.
    df = matches.withColumn("_in_region", region_flag(cfg, box))
    reg = c("_in_region")
    both = lambda a, b: c(a).isNotNull() & c(b).isNotNull()
    return df.select(
        status.alias("match_status"),
        c(f"{l}_id"), c(f"{r}_id"), c(f"{l}_mag"), c(f"{r}_mag"), c(f"{l}_place"), c(f"{r}_place"),
        F.when(
            matched,
            F.when(reg, F.concat(F.lit("unified_"), F.coalesce(c(f"{r}_id"), c(f"{l}_id")))).otherwise(
                F.concat(F.lit("unified_"), F.coalesce(c(f"{l}_id"), c(f"{r}_id")))
            ),
        )
        .when(status == f"{l}_only", F.concat(F.lit("unified_"), c(f"{l}_id")))
        .when(status == f"{r}_only", F.concat(F.lit("unified_"), c(f"{r}_id")))
        .alias("unified_id"),
        F.coalesce(c(f"{l}_time"), c(f"{r}_time")).alias("event_time"),
        F.when(reg, F.coalesce(c(f"{r}_lat"), c(f"{l}_lat"))).otherwise(F.coalesce(c(f"{l}_lat"), c(f"{r}_lat")))
        .alias("canonical_lat"),
        F.when(reg, F.coalesce(c(f"{r}_lon"), c(f"{l}_lon"))).otherwise(F.coalesce(c(f"{l}_lon"), c(f"{r}_lon")))
        .alias("canonical_lon"),
        F.when(matched & reg, F.coalesce(c(f"{r}_mag"), c(f"{l}_mag")))
        .otherwise(F.coalesce(c(f"{l}_mag"), c(f"{r}_mag")))
        .alias("canonical_mag"),
        F.when(both(f"{l}_mag", f"{r}_mag"), F.round(F.abs(c(f"{l}_mag") - c(f"{r}_mag")), 2)).alias(
            "mag_disagreement"
        ),
        F.when(both(f"{l}_time", f"{r}_time"), c("time_diff_seconds")).alias("time_diff_seconds"),
        F.when(both(f"{l}_lat", f"{r}_lat") & both(f"{l}_lon", f"{r}_lon"), F.round(c("distance_km"), 1)).alias(
            "distance_km"
        ),
        F.when(matched, F.lit("both"))
        .when(status == f"{l}_only", F.lit(l))
        .when(status == f"{r}_only", F.lit(r))
        .alias("sources_available"),
        F.lit(processed_at).cast("timestamp").alias("processed_at"),
    )
