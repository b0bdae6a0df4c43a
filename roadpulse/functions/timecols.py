"""Time expressions over text timestamps of uneven quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAY, WEEKEND, UNKNOWN = "weekday", "weekend", "unknown"


def parse_time(c: str | Column) -> Column:
    """Text to timestamp, null where it does not parse.

    Without a zone, so no session setting moves a record to another day. A plain
    ``to_timestamp`` would fail the whole job on the first bad value (ANSI mode).
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("timestamp_ntz")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, each cut to its second first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def day_type(ts: Column, unknown: str = UNKNOWN) -> Column:
    """``weekday`` or ``weekend`` (``dayofweek`` counts from Sunday = 1)."""
    return (
        F.when(ts.isNull(), unknown)
        .when(F.dayofweek(ts).isin(1, 7), WEEKEND)
        .otherwise(WEEKDAY)
    )
