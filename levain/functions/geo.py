"""Great-circle distance as a Column expression (JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used by the reference distance fact.
EARTH_RADIUS_KM = 6371.0


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km between two (lat, lon) points given in degrees.

    ``asin`` is fed ``least(1, sqrt(a))``: for antipodes rounding can push ``a`` a hair
    above 1, where ``asin`` would return NaN instead of pi.
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
