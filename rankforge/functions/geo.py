"""Great-circle distance and the box around a circle."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius, and metres per distance unit.
EARTH_RADIUS_M = 6371008.7714
METRES = {
    "mm": 0.001, "cm": 0.01, "m": 1.0, "km": 1000.0, "in": 0.0254, "ft": 0.3048,
    "yd": 0.9144, "mi": 1609.344, "nmi": 1852.0,
}


def parse_distance(distance: str | float) -> float:
    """``"500km"``, ``"3 mi"`` or a bare number of metres, in metres."""
    m = re.fullmatch(r"\s*([0-9]*\.?[0-9]+)\s*([a-zA-Z]*)\s*", str(distance))
    unit = (m.group(2).lower() or "m") if m else None
    if unit not in METRES:
        raise ValueError(f"cannot read a distance from {distance!r}")
    return float(m.group(1)) * METRES[unit]


def haversine_m(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Metres from every (lat, lon) to one fixed point."""
    h = F.pow(F.sin(F.radians(lat - F.lit(lat0)) / 2), 2) + F.cos(F.radians(lat)) * F.lit(
        math.cos(math.radians(lat0))
    ) * F.pow(F.sin(F.radians(lon - F.lit(lon0)) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def within(lat: Column, lon: Column, lat0: float, lon0: float, metres: float) -> Column:
    """Inside the circle. A latitude/longitude box that holds the circle comes
    first: those are plain comparisons, which reach the parquet statistics."""
    # widened by a hair, so that rounding cannot cut off a point on the rim
    angle = metres / EARTH_RADIUS_M * (1 + 1e-9) + 1e-12
    dlat = math.degrees(angle)
    lo, hi = lat0 - dlat, lat0 + dlat
    cond = lat.between(lo, hi)
    if lo > -90 and hi < 90:
        # the meridians that touch the circle
        dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat0)))))
        if -180 <= lon0 - dlon and lon0 + dlon <= 180:
            cond = cond & lon.between(lon0 - dlon, lon0 + dlon)
    return cond & (haversine_m(lat, lon, lat0, lon0) <= metres)
