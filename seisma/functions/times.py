"""Time column expressions: whole-second differences and feed time parsers.

All functions assume the session time zone is UTC (see ``seisma.session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def seconds_between(a, b) -> Column:
    """``ABS(TIMESTAMP_DIFF(a, b, SECOND))``: whole seconds, truncated toward zero."""
    return F.abs(F.timestamp_diff("SECOND", _c(b), _c(a)))


def minutes_between(a, b) -> Column:
    """``TIMESTAMP_DIFF(a, b, MINUTE)`` (signed, truncated)."""
    return F.timestamp_diff("MINUTE", _c(b), _c(a))


def epoch_ms_to_ts(c) -> Column:
    """Epoch milliseconds (number or numeric text) to a UTC timestamp; NULL stays NULL."""
    c = _c(c)
    return F.timestamp_millis(F.round(c.try_cast("double")).cast("bigint"))


_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
_LOCAL = r"^[0-9]{4}[-.][0-9]{1,2}[-.][0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
# ISO-8601 as the feeds write it: extended or basic date, any part of the time, fractions of any
# length, offset as Z or +hh[:mm[:ss]].  Groups: year month day hour minute second fraction offset.
_ISO = (r"^([0-9]{4})-?([0-9]{2})-?([0-9]{2})"
        r"(?:[T ]([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?"
        r"(Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)?)?$")


def _iso(s: Column) -> tuple[Column, Column]:
    """(wall clock as if UTC, offset in seconds or NULL) of ISO text; both NULL for other text."""
    def part(i: int) -> Column:
        return F.regexp_extract(s, _ISO, i)

    def two(i: int) -> Column:
        return F.coalesce(F.nullif(part(i), F.lit("")), F.lit("00"))

    text = F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit(" "), two(4), F.lit(":"), two(5), F.lit(":"), two(6),
                    F.lit("."), F.rpad(F.substring(part(7), 1, 6), 6, "0"))
    clock = F.when(s.rlike(_ISO), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")))
    zone = part(8)
    digits = F.rpad(F.regexp_replace(zone, "[^0-9]", ""), 6, "0")
    seconds = (F.substring(digits, 1, 2).try_cast("bigint") * 3600 + F.substring(digits, 3, 2).try_cast("bigint") * 60
               + F.substring(digits, 5, 2).try_cast("bigint"))
    offset = F.when(zone == "Z", F.lit(0).cast("bigint")).when(zone != "", F.when(zone.startswith("-"), -seconds).otherwise(seconds))
    return clock, offset


def _shifted(clock: Column, offset: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(clock) - offset * 1_000_000)


def parse_local_ts(c, zone: str = "Europe/Istanbul") -> Column:
    """Feed time text to UTC; naive wall-clock text is read in ``zone``.

    Shapes, tested in this order (the shape test must come first, because a
    lenient parser would read plain ``'2024'`` as a year):
      number                      -> epoch milliseconds
      ``yyyy-MM-dd HH:mm:ss`` (or dots as date separators) -> local wall clock
      ISO-8601 with ``Z``/offset  -> that instant
      ISO-8601 without offset     -> local wall clock
    anything else -> NULL.
    """
    s = F.trim(_c(c).cast("string"))
    local = F.regexp_replace(s, r"^([0-9]{4})[-.]([0-9]{1,2})[-.]([0-9]{1,2}) ", "$1-$2-$3 ")
    local_ts = F.try_to_timestamp(local, F.lit("yyyy-M-d H:m:s"))
    clock, offset = _iso(s)
    return (
        F.when(s.rlike(_NUMBER), epoch_ms_to_ts(s))
        .when(s.rlike(_LOCAL), F.to_utc_timestamp(local_ts, zone))
        .when(offset.isNotNull(), _shifted(clock, offset))
        .otherwise(F.to_utc_timestamp(clock, zone))
    )


def parse_iso_utc(c) -> Column:
    """ISO-8601 text to UTC (``Z`` or offset honoured, naive = UTC); number = epoch ms; bad -> NULL."""
    s = F.trim(_c(c).cast("string"))
    clock, offset = _iso(s)
    return F.when(s.rlike(_NUMBER), epoch_ms_to_ts(s)).when(offset.isNotNull(), _shifted(clock, offset)).otherwise(clock)


def to_utc_iso(c) -> Column:
    """UTC instant as ISO-8601 text with ``+00:00``; microseconds only when non-zero."""
    c = _c(c)
    whole = F.unix_micros(c) % 1_000_000 == 0
    return F.when(whole, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def ntz(c) -> Column:
    """UTC instant as a wall-clock TIMESTAMP_NTZ (what naive-timestamp engines hold)."""
    return _c(c).cast("timestamp_ntz")
