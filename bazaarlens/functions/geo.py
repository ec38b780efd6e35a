"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

EARTH_RADIUS_KM = 6371


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Kilometres between two points; NULL when either point is unknown.

    The sum under the root is deliberately not clamped with ``least``: that
    function skips NULLs and would place unknown points half the globe apart.
    """
    half_lat = F.sin(F.radians(col(lat2) - col(lat1)) / 2)
    half_lng = F.sin(F.radians(col(lng2) - col(lng1)) / 2)
    chord = F.pow(half_lat, 2) + F.cos(F.radians(col(lat1))) * F.cos(F.radians(col(lat2))) * F.pow(half_lng, 2)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))
