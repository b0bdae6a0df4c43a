"""Mean clearance time by light condition and day type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.timecols import UNKNOWN, day_type, elapsed_seconds, parse_time


def clearance_by(
    df: DataFrame,
    lights: Sequence[str] = ("sunrise_sunset",),
    start: str = "start_time",
    end: str = "end_time",
    unknown: str = UNKNOWN,
) -> DataFrame:
    """Per light column(s) and day type: mean minutes from start to end.

    Rows without a light value are left out. Where the start time does not
    parse, the day type is ``unknown``; pass ``"weekday"`` to count such rows
    there (they have no clearance time, so no mean changes).
    """
    start_ts, end_ts = parse_time(start), parse_time(end)
    rows = df
    for light in lights:
        rows = rows.filter(F.col(light).isNotNull())
    return (
        rows.select(
            *lights,
            day_type(start_ts, unknown).alias("day_type"),
            elapsed_seconds(start_ts, end_ts).alias("seconds"),
        )
        .groupBy(*lights, "day_type")
        .agg((F.avg("seconds") / 60.0).alias("mean_clearance_min"), F.count("*").alias("incidents"))
        .orderBy(*lights, "day_type")
    )
