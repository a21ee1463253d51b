import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seisma.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="seisma-tests")
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


EVENT_SCHEMA = "earthquake_id string, event_time timestamp, mag double, lon double, lat double, place string"


def events(spark, rows):
    """Staging-shaped events: (id, 'YYYY-MM-DD HH:MM:SS[.f]', mag, lon, lat[, place])."""
    out = []
    for r in rows:
        r = list(r) + [None] * (6 - len(r))
        out.append((r[0], ts(r[1]) if r[1] else None, r[2], r[3], r[4], r[5] or f"place {r[0]}"))
    return spark.createDataFrame(out, EVENT_SCHEMA)
