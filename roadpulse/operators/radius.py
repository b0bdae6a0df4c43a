"""Records within a great-circle radius of a point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.geo import great_circle_km, may_be_within

# Default centre (degrees) and radius (km).
DEFAULT_LAT = 34.05
DEFAULT_LNG = -118.24
DEFAULT_RADIUS_KM = 25.0


def radius_search(
    df: DataFrame,
    lat: str = "start_lat",
    lng: str = "start_lng",
    lat0: float = DEFAULT_LAT,
    lng0: float = DEFAULT_LNG,
    radius_km: float = DEFAULT_RADIUS_KM,
) -> DataFrame:
    """Rows with ``distance_km <= radius_km``, with that column added.

    Narrow: no shuffle. The bounding box goes to the scan, and the trigonometry
    runs only on what the box lets through.
    """
    return (
        df.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull())
        .filter(may_be_within(lat, lng, lat0, lng0, radius_km))
        .withColumn("distance_km", great_circle_km(lat, lng, lat0, lng0))
        .filter(F.col("distance_km") <= float(radius_km))
    )


def nearest(hits: DataFrame, k: int = 10, tie_break: str | None = None) -> DataFrame:
    """The ``k`` closest rows of a radius search (per-task heaps, no full sort).

    With ``tie_break``, distances equal to the millimetre go by that column.
    """
    if tie_break is None:
        return hits.orderBy("distance_km").limit(k)
    return hits.orderBy(F.round("distance_km", 6), tie_break).limit(k)


def hit_count(hits: DataFrame) -> DataFrame:
    """Number of rows in the radius, as a one-row frame."""
    return hits.agg(F.count("*").alias("incidents"))
