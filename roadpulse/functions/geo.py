"""Great-circle distance and the bounding box that lets a scan skip data."""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0

# Slack in degrees (about 0.1 mm) so that float error never loses a true hit.
_SLACK_DEG = 1e-9


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _num(x: float | Column) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def great_circle_km(
    lat: str | Column, lng: str | Column, lat0: float | Column, lng0: float | Column
) -> Column:
    """Haversine distance in km between (lat, lng) and (lat0, lng0), in degrees.

    Null where a coordinate is null. Float error can push the haversine of
    antipodes just above 1, where asin is NaN; they are half a turn apart.
    """
    phi, phi0 = F.radians(_col(lat)), F.radians(_num(lat0))
    half_dphi = (phi0 - phi) / 2
    half_dlambda = (F.radians(_num(lng0)) - F.radians(_col(lng))) / 2
    hav = F.pow(F.sin(half_dphi), 2) + F.cos(phi) * F.cos(phi0) * F.pow(F.sin(half_dlambda), 2)
    # Written so that the haversine stands in the expression once: a filter
    # evaluates every mention of it.
    half_angle = F.nanvl(F.asin(F.sqrt(hav)), F.lit(math.pi / 2))
    return F.lit(2 * EARTH_RADIUS_KM) * half_angle


def _longitude_ranges(lat0: float, lng0: float, radius_km: float) -> list[tuple[float, float]] | None:
    """Longitude intervals touched by the cap, or None for "every longitude"."""
    angle = radius_km / EARTH_RADIUS_KM
    reach = math.degrees(angle)
    if abs(lat0) + reach + _SLACK_DEG >= 90.0:
        return None
    half = math.degrees(math.asin(math.sin(angle) / math.cos(math.radians(lat0)))) + _SLACK_DEG
    west, east = lng0 - half, lng0 + half
    if west < -180.0:
        return [(-180.0, east), (west + 360.0, 180.0)]
    if east > 180.0:
        return [(west, 180.0), (-180.0, east - 360.0)]
    return [(west, east)]


def bounding_box(lat0: float, lng0: float, radius_km: float) -> tuple[tuple[float, float], list[tuple[float, float]]]:
    """Range of latitudes, and ranges of longitudes (two across the seam), that hold every place within the radius."""
    reach = math.degrees(radius_km / EARTH_RADIUS_KM) + _SLACK_DEG
    return (lat0 - reach, lat0 + reach), _longitude_ranges(lat0, lng0, radius_km) or [(-180.0, 180.0)]


def may_be_within(
    lat: str | Column, lng: str | Column, lat0: float, lng0: float, radius_km: float
) -> Column:
    """Necessary condition for lying within the radius, on the raw columns only.

    Plain comparisons against literals reach the Parquet scan, which a filter on
    the computed distance cannot. Numbers off the usual range pass through, so
    the exact test alone decides on them; NaN and infinities are no place.
    """
    lat, lng = _col(lat), _col(lng)
    reach = math.degrees(radius_km / EARTH_RADIUS_KM) + _SLACK_DEG
    box = (lat >= lat0 - reach) & (lat <= lat0 + reach)
    ranges = _longitude_ranges(lat0, lng0, radius_km)
    if ranges is not None:
        hit = None
        for west, east in ranges:
            part = (lng >= west) & (lng <= east)
            hit = part if hit is None else hit | part
        box = box & hit
    finite = sys.float_info.max
    finite_pair = (lat >= -finite) & (lat <= finite) & (lng >= -finite) & (lng <= finite)
    off_range = (lat < -90.0) | (lat > 90.0) | (lng < -180.0) | (lng > 180.0)
    return finite_pair & (box | off_range)
