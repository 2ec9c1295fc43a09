"""Distances and positions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
EARTH_RADIUS_KM = 6371.0


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def _squared_sine_of_half(a: Column, b: Column) -> Column:
    return F.pow(F.sin(F.radians(b - a) / 2), F.lit(2.0))


def haversine_h(lat1, lon1, lat2, lon2) -> Column:
    """The haversine itself: grows with distance, so it ranks like metres do."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    return (_squared_sine_of_half(lat1, lat2)
            + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * _squared_sine_of_half(lon1, lon2))


def metres_from_h(h: Column) -> Column:
    return EARTH_RADIUS_M * 2 * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    return metres_from_h(haversine_h(lat1, lon1, lat2, lon2))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Arcsine form in kilometres; the root is clamped for antipodal points."""
    h = haversine_h(lat1, lon1, lat2, lon2)
    return 2.0 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def segment_fraction(plat, plon, a_lat, a_lon, b_lat, b_lon) -> Column:
    """Where the point projects on the segment, in raw degrees; 0 if it has no length."""
    plat, plon, a_lat, a_lon, b_lat, b_lon = map(_col, (plat, plon, a_lat, a_lon, b_lat, b_lon))
    dx, dy = b_lat - a_lat, b_lon - a_lon
    squared = dx * dx + dy * dy
    return F.when(squared > 0, ((plat - a_lat) * dx + (plon - a_lon) * dy) / squared).otherwise(F.lit(0.0))


def foot_coordinate(t: Column, a, b) -> Column:
    """Coordinate at fraction ``t``; the exact endpoint beyond either end, so ties stay bit-equal."""
    a, b = _col(a), _col(b)
    return F.when(t <= 0, a).when(t >= 1, b).otherwise(a + t * (b - a))


def point_segment_m(plat, plon, a_lat, a_lon, b_lat, b_lon) -> Column:
    t = segment_fraction(plat, plon, a_lat, a_lon, b_lat, b_lon)
    return haversine_m(plat, plon, foot_coordinate(t, a_lat, b_lat), foot_coordinate(t, a_lon, b_lon))


def planar_d2(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    dlat, dlon = lat2 - lat1, lon2 - lon1
    return dlat * dlat + dlon * dlon


def midpoint(a, b) -> Column:
    return (_col(a) + _col(b)) / 2


def interpolate(a, b, travelled_m, length_m) -> Column:
    """Coordinate after ``travelled_m`` metres of an edge; its start if it has no length."""
    length = _col(length_m)
    ratio = F.when(length > 0, _col(travelled_m) / length).otherwise(F.lit(0.0))
    return _col(a) + (_col(b) - _col(a)) * ratio
