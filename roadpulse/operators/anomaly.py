"""Days on which an entity saw far more records than its own history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadpulse.functions.timecols import parse_time

# Standard deviations above the mean, size of the ranking.
SIGMAS = 3.0
TOP_DAYS = 5

WEATHER = {"mean_precipitation": "precipitation_in", "mean_visibility": "visibility_mi"}
WEATHER_WITH_WIND = {**WEATHER, "mean_wind_speed": "wind_speed_mph"}


def daily_rollup(
    df: DataFrame,
    entity: str = "state",
    time: str = "start_time",
    means: Mapping[str, str] = WEATHER,
    day_from: str = "parsed",
) -> DataFrame:
    """Per entity and day: number of rows and the mean of each measure.

    ``day_from="parsed"`` takes the date of the parsed time and leaves out rows
    whose time does not parse. ``"prefix"`` takes the first ten characters of
    the text as they are, so a malformed time makes a "day" of its own.
    """
    if day_from == "parsed":
        day = F.to_date(parse_time(time))
    elif day_from == "prefix":
        day = F.substring(F.col(time), 1, 10)
    else:
        raise ValueError(f"day_from must be 'parsed' or 'prefix', not {day_from!r}")
    return (
        df.filter(F.col(entity).isNotNull())
        .select(F.col(entity), day.alias("day"), *[F.col(c) for c in dict.fromkeys(means.values())])
        .groupBy(entity, "day")
        .agg(
            F.count("day").alias("day_incidents"),
            *[F.avg(c).alias(name) for name, c in means.items()],
        )
        # Rows without a time, or one that does not parse, end up in a group that
        # counts none. A filter on the day itself would move below the grouping
        # and parse every time twice.
        .filter(F.col("day_incidents") > 0)
    )


def _mean_and_std(metric: str) -> tuple[Column, Column]:
    # As double from the start: on a bigint, mean and deviation would become two
    # separate window operators with a cast in between.
    value = F.col(metric).cast("double")
    return F.avg(value), F.stddev_samp(value)


def entity_history(daily: DataFrame, entity: str = "state", metric: str = "day_incidents") -> DataFrame:
    """Per entity over its observed days: mean and sample deviation of ``metric``."""
    mean, std = _mean_and_std(metric)
    return (
        daily.filter(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(mean.alias("hist_mean"), std.alias("hist_std"), F.count("*").alias("observed_days"))
    )


def sigma_anomalies(
    daily: DataFrame,
    entity: str = "state",
    metric: str = "day_incidents",
    sigmas: float = SIGMAS,
    form: str = "window",
) -> DataFrame:
    """Days with ``metric`` strictly above ``hist_mean + sigmas * hist_std``.

    Both forms give the same rows. ``window`` reads ``daily`` once and brings
    all days of an entity to one task: as many rows as the calendar has days,
    however many records lie behind them. ``join`` aggregates the history on the
    map side and joins it back, so no task sees a whole entity; take it where
    periods per entity have no such bound. It reads ``daily`` twice, so give it
    a written rollup (``shared_dir.written``) and not the query that makes it.
    An entity with a single day has no deviation and no anomaly.
    """
    if form == "join":
        history = entity_history(daily, entity, metric).drop("observed_days")
        scored = daily.join(history, entity)
    elif form == "window":
        over = Window.partitionBy(entity)
        mean, std = _mean_and_std(metric)
        scored = daily.filter(F.col(entity).isNotNull()).withColumns(
            {"hist_mean": mean.over(over), "hist_std": std.over(over)}
        )
    else:
        raise ValueError(f"form must be 'join' or 'window', not {form!r}")
    return scored.withColumn(
        "threshold", F.col("hist_mean") + F.lit(float(sigmas)) * F.col("hist_std")
    ).filter(F.col(metric) > F.col("threshold"))


def top_days(
    anomalies: DataFrame, k: int = TOP_DAYS, entity: str = "state", metric: str = "day_incidents"
) -> DataFrame:
    """The ``k`` heaviest anomalous days; equal counts go by entity and day."""
    return anomalies.orderBy(F.desc(metric), entity, "day").limit(k)


def anomaly_count(anomalies: DataFrame) -> DataFrame:
    """Number of anomalous days, as a one-row frame."""
    return anomalies.agg(F.count("*").alias("anomalies"))
