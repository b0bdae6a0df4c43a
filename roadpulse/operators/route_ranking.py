"""Ranking of roads by severe incidents, with the mean time to clear them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.routes import highway, normalise_route
from roadpulse.functions.timecols import elapsed_seconds, parse_time
from roadpulse.operators.hotspots import severe

# Fixed value: size of the ranking.
TOP_ROUTES = 10


def street_routes(df: DataFrame, street: str = "street", anchored: bool = False) -> DataFrame:
    """Every distinct street with the route it is counted under."""
    return (
        df.filter(F.col(street).isNotNull())
        .select(F.col(street).alias("street"))
        .distinct()
        .withColumn("route", normalise_route("street", anchored))
    )


def route_totals(
    df: DataFrame,
    street: str = "street",
    start: str = "start_time",
    end: str = "end_time",
    where: Column | None = None,
    anchored: bool = False,
    highways_only: bool = False,
) -> DataFrame:
    """Per route: number of rows and mean clearance in minutes.

    Rows are totalled per raw street first, then streets per route: the regular
    expressions run once per distinct street and not once per row, and a road
    with a third of all rows is already one row per task in the first shuffle.
    Seconds are whole numbers, so the sums do not depend on the order of rows.
    """
    seconds = elapsed_seconds(parse_time(start), parse_time(end)).cast("double")
    per_street = (
        df.filter((severe() if where is None else where) & F.col(street).isNotNull())
        .select(F.col(street).alias("street"), seconds.alias("seconds"))
        .groupBy("street")
        .agg(
            F.count("*").alias("rows"),
            F.count("seconds").alias("timed"),
            F.sum("seconds").alias("seconds"),
        )
    )
    if highways_only:
        named = per_street.withColumn("route", highway("street", anchored)).filter("route IS NOT NULL")
    else:
        named = per_street.withColumn("route", normalise_route("street", anchored))
    timed = F.sum("timed")
    return named.groupBy("route").agg(
        F.sum("rows").alias("incidents"),
        F.when(timed > 0, F.sum("seconds") / timed / 60.0).alias("mean_clearance_min"),
    )


def route_ranking(totals: DataFrame, k: int = TOP_ROUTES) -> DataFrame:
    """The ``k`` routes with most rows; equal counts go by name."""
    return totals.orderBy(F.desc("incidents"), "route").limit(k)
