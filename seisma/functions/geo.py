"""Geographic column expressions (pure JVM-side Column arithmetic, no UDF)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results:
# mean Earth radius used by the distance formula, in km.
EARTH_RADIUS_KM = 6371.0


@dataclass(frozen=True)
class Box:
    """Inclusive latitude/longitude box (BETWEEN on both axes)."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# The region whose local agency is preferred for canonical values.
REGION_BOX = Box(lat_min=35.0, lat_max=43.0, lon_min=25.0, lon_max=46.0)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km; NULL if any input is NULL.

    The square-root argument is clamped to 1.0: rounding can push it a hair
    above 1 for antipodal points, where ``asin`` would return NaN.
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    half = F.lit(math.pi / 360.0)
    rad = F.lit(math.pi / 180.0)
    a = F.pow(F.sin((lat2 - lat1) * half), 2) + F.cos(lat1 * rad) * F.cos(lat2 * rad) * F.pow(
        F.sin((lon2 - lon1) * half), 2
    )
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def in_box(lat, lon, box: Box = REGION_BOX) -> Column:
    """``lat BETWEEN lo AND hi AND lon BETWEEN lo AND hi`` (NULL if a coordinate is NULL)."""
    lat, lon = _c(lat), _c(lon)
    return lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max)


def km_to_lat_degrees(km: float, radius_km: float = EARTH_RADIUS_KM) -> float:
    """Latitude span that a great-circle distance of ``km`` can at most cover."""
    return km / (radius_km * math.pi / 180.0)
