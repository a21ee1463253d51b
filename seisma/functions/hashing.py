"""Hash / identifier column expressions used by the landing layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def content_hash(c, length: int = 8) -> Column:
    """First ``length`` hex digits of the MD5 of a text column (archive object suffix / dedup key)."""
    return F.substring(F.md5(_c(c).cast("string")), 1, length)


def _canonical(c) -> Column:
    """JSON text without blanks and with sorted keys; text that is no JSON as it is."""
    text = _c(c).cast("string")
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def document_hash(c, length: int = 8) -> Column:
    """Content hash of a JSON document: the order of its keys and its blanks do not count (text that is no JSON: as it is)."""
    return content_hash(_canonical(c), length)


def document_digest(c) -> Column:
    """A JSON document's identity: the whole SHA-256 of the same text that ``document_hash`` shortens."""
    return F.sha2(_canonical(c).cast("binary"), 256)


def struct_content_hash(*cols: str, length: int = 8) -> Column:
    """Content hash of a record: JSON of the key-sorted fields, then MD5."""
    names = sorted(cols)
    return content_hash(F.to_json(F.struct(*[F.col(n) for n in names])), length)


def staging_name(c, length: int = 8) -> Column:
    """Isolated staging suffix: id without dashes, lower case, first ``length`` chars."""
    return F.substring(F.lower(F.replace(_c(c).cast("string"), F.lit("-"), F.lit(""))), 1, length)
