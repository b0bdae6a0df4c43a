"""Spatial hotspots on a rounded-coordinate grid."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.geo import EARTH_RADIUS_KM, great_circle_km

# Severity from which an incident counts as severe, grid
# decimals (0.01 degree, about 1.1 km), size of the ranking.
SEVERE_FROM = 3
GRID_DECIMALS = 2
TOP_CELLS = 5


def severe(severity: str = "severity") -> Column:
    return F.col(severity) >= SEVERE_FROM


def grid_cells(
    df: DataFrame,
    lat: str = "start_lat",
    lng: str = "start_lng",
    decimals: int = GRID_DECIMALS,
    where: Column | None = None,
    weight: str | Column | None = None,
) -> DataFrame:
    """Per occupied cell: number of rows, and the sum of ``weight`` if given.

    One shuffle. The map side aggregates first, so a cell with a third of all
    rows reaches the shuffle as one row per task.
    """
    rows = df.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull())
    if where is not None:
        rows = rows.filter(where)
    measures = [F.count("*").alias("incidents")]
    if weight is not None:
        measures.append(F.sum(weight).alias("danger"))
    return rows.groupBy(
        F.round(lat, decimals).alias("lat_cell"), F.round(lng, decimals).alias("lng_cell")
    ).agg(*measures)


def top_cells(cells: DataFrame, k: int = TOP_CELLS, by: str = "incidents") -> DataFrame:
    """The ``k`` heaviest cells; equal weights go by cell."""
    return cells.orderBy(F.desc(by), "lat_cell", "lng_cell").limit(k)


def grid_hotspots(
    df: DataFrame,
    lat: str = "start_lat",
    lng: str = "start_lng",
    where: Column | None = None,
    decimals: int = GRID_DECIMALS,
    k: int = TOP_CELLS,
) -> DataFrame:
    """Top cells by number of severe rows (``where`` replaces that criterion)."""
    where = severe() if where is None else where
    return top_cells(grid_cells(df, lat, lng, decimals, where), k)


def off_range(lat: str = "start_lat", lng: str = "start_lng") -> Column:
    """Whether a row has coordinates that are no place on the globe.

    Grid cells round such coordinates like any others and radius search puts
    them into its formula as they are; a true radius around a cell has no
    meaning for them, so ``cells_within_radius`` leaves these rows out.
    """
    outside = (F.abs(lat) > 90.0) | (F.abs(lng) > 180.0) | F.isnan(F.col(lat).cast("double")) | F.isnan(F.col(lng).cast("double"))
    return F.coalesce(outside, F.lit(False))


def cells_within_radius(
    df: DataFrame,
    radius_km: float = 2.0,
    lat: str = "start_lat",
    lng: str = "start_lng",
    decimals: int = GRID_DECIMALS,
    where: Column | None = None,
) -> DataFrame:
    """Per occupied cell: rows within ``radius_km`` of the cell's centre point.

    No join and no pairs of rows. In each lattice row that its disc touches, a
    distinct coordinate covers one run of lattice points. Only the two ends of
    the run are sent, the row count where it begins and its negative after it
    ends, so what is shuffled grows with the radius and not with its square. The
    ends add up per lattice point on the map side; a running sum along each
    lattice row, which has at most one turn of points, then gives every point's
    count. Exact distances decide about the ends. A cell is occupied if a row
    rounds to it. Rows that are ``off_range`` are left out; to see them, filter
    by it.
    """
    scale = 10**decimals
    turn, west = 360 * scale, -180 * scale
    angle = min(radius_km / EARTH_RADIUS_KM, math.pi)
    reach = math.degrees(angle) + 1e-9
    phi, lam, i = F.col("lat"), F.col("lng"), F.col("i")

    rows = df if where is None else df.filter(where)
    points = (
        rows.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull() & ~off_range(lat, lng))
        .select(F.col(lat).cast("double").alias("lat"), F.col(lng).cast("double").alias("lng"))
        .groupBy("lat", "lng")
        .agg(F.count("*").alias("n"))
        # Neighbours to the same task, so that the sums below start there: what is
        # shuffled next grows with the places and not with the points.
        .repartitionByRange(F.floor(phi * 2), "lng", "lat")
    )
    own_i = F.round(F.round(phi, decimals) * scale).cast("long")
    own_j = F.pmod(F.round(F.round(lam, decimals) * scale).cast("long") - west, F.lit(turn)) + west

    # Lattice rows the disc can touch, and the row of the point's own cell.
    first_i = F.greatest(F.ceil((phi - reach) * scale), F.lit(-90 * scale))
    last_i = F.least(F.floor((phi + reach) * scale), F.lit(90 * scale))
    by_row = points.withColumns({"own_i": own_i, "own_j": own_j}).withColumn(
        "i", F.explode(F.sequence(F.least("own_i", first_i), F.greatest("own_i", last_i)))
    )

    # Half chord of the disc in that row, out of hav(d) = hav(dlat) + cos cos hav(dlng).
    # All of the row where it lies inside; a little wider, as the distance decides.
    row_phi = i / scale
    hav_lat = F.pow(F.sin(F.radians(row_phi - phi) / 2), 2)
    cosines = F.cos(F.radians(phi)) * F.cos(F.radians(row_phi))
    hav_lng = (F.lit(math.sin(angle / 2) ** 2) - hav_lat) / F.greatest(cosines, F.lit(1e-300))
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), hav_lng))
    half = F.degrees(F.asin(F.sqrt(clamped))) * 2 + 1e-6
    by_row = by_row.withColumn("half", half).withColumns(
        {"wide_first": F.ceil((lam - F.col("half")) * scale), "wide_last": F.floor((lam + F.col("half")) * scale)}
    )
    inside = [great_circle_km(phi, lam, row_phi, F.col(end) / scale) <= float(radius_km) for end in ("wide_first", "wide_last")]
    by_row = by_row.withColumns(
        {
            "first_j": F.when(inside[0], F.col("wide_first")).otherwise(F.col("wide_first") + 1),
            "last_j": F.when(inside[1], F.col("wide_last")).otherwise(F.col("wide_last") - 1),
        }
    )

    # Begin and end of the run in one turn from -180 on: a run over the seam is
    # two, and one of a whole turn or more is the row.
    begin, size = F.pmod(F.col("first_j") - west, F.lit(turn)) + west, F.col("last_j") - F.col("first_j") + 1
    over = begin + size - (west + turn)
    none, n = F.lit(0).cast("long"), F.col("n")

    def event(at: Column, change: Column, own: Column = F.lit(False)) -> Column:
        return F.struct(at.cast("long").alias("j"), change.cast("long").alias("change"), own.alias("occupied"))

    run = (
        F.when(size <= 0, F.array(event(F.lit(west), none)))
        .when(size >= turn, F.array(event(F.lit(west), n)))
        .when(over <= 0, F.array(event(begin, n), event(begin + size, -n)))
        .otherwise(F.array(event(begin, n), event(F.lit(west), n), event(west + over, -n)))
    )
    own = F.when(i == F.col("own_i"), F.array(event(F.col("own_j"), none, F.lit(True))))
    events = by_row.select("i", F.explode(F.concat(run, F.coalesce(own, F.slice(run, 1, 0)))).alias("e")).select("i", "e.*")
    along = Window.partitionBy("i").orderBy("j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        events.groupBy("i", "j")
        .agg(F.sum("change").alias("change"), F.bool_or("occupied").alias("occupied"))
        .withColumn("incidents", F.sum("change").over(along))
        .filter("occupied")
        .select((F.col("i") / scale).alias("lat_cell"), (F.col("j") / scale).alias("lng_cell"), "incidents")
    )
