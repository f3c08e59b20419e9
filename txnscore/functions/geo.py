"""Great-circle distance (O15, O16) as one Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used for the distance feature.
EARTH_RADIUS_KM = 6371.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_radians_terms(lat1, lon1, lat2, lon2) -> dict[str, Column]:
    """Coordinates in radians and their differences (the intermediate terms)."""
    r_lat1, r_lon1 = F.radians(_c(lat1)), F.radians(_c(lon1))
    r_lat2, r_lon2 = F.radians(_c(lat2)), F.radians(_c(lon2))
    return {"lat1": r_lat1, "lon1": r_lon1, "lat2": r_lat2, "lon2": r_lon2,
            "dlat": r_lat2 - r_lat1, "dlon": r_lon2 - r_lon1}


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    t = to_radians_terms(lat1, lon1, lat2, lon2)
    a = (F.pow(F.sin(t["dlat"] / 2), 2)
         + F.cos(t["lat1"]) * F.cos(t["lat2"]) * F.pow(F.sin(t["dlon"] / 2), 2))
    # Rounding can push `a` a hair above 1 for antipodal points; clamp it so
    # asin stays defined. NaN input stays NaN (Spark orders NaN above 1).
    a = F.when(F.isnan(a), a).when(a > 1.0, F.lit(1.0)).otherwise(a)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))
