"""Places and their surroundings without a radius given, or for many centres at once.

Many centres meet the rows by cells: bands of latitude, cut into columns about as
wide as high. A row lies in one cell; a centre looks at the cells that its circle may
touch, each of them once. So each pair is met once, however near the pole or the
seam of longitudes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.geo import EARTH_RADIUS_KM, great_circle_km
from roadpulse.operators import radius as radius_job
from roadpulse.sources.shared_dir import written

#: First radius that is tried for the nearest rows, how much wider the next one is, and how many are tried.
FIRST_KM = 1.0
WIDER = 8.0
TRIES = 2
# Half way round the globe, and a little more.
_EVERYWHERE_KM = math.pi * EARTH_RADIUS_KM + 1.0

#: Cells to a radius where only numbers are asked for: the finer, the more cells lie wholly inside a circle.
FINE = 4

#: Rows of a cell beyond which it is dealt to several tasks, and cells of that kind up to which their list is broadcast.
DENSE_ROWS = 200_000
MOST_DENSE_CELLS = 100_000

#: Where pairs are listed, rows and circles of a cell beyond which it is dealt in blocks, and pairs that a task looks at.
BLOCK_ROWS = 32_768
BLOCK_CIRCLES = 4_096
TASK_PAIRS = 16 << 20
MOST_TASKS = 20_000

_SLACK_DEG = 1e-9


def nearest_anywhere(
    df: DataFrame,
    lat0: float,
    lng0: float,
    k: int = 10,
    lat: str = "start_lat",
    lng: str = "start_lng",
    tie_break: str | None = None,
    first_km: float = FIRST_KM,
) -> DataFrame:
    """The ``k`` rows nearest to a point, with ``distance_km``, however far they are (a few actions, then lazy).

    A circle that holds ``k`` rows holds the nearest ones: whatever lies outside is
    farther. Small circles are tried first, and read only what their box lets
    through, so in dense places that is all. If they hold too few, one pass counts
    the rows per ring, each ring as wide as all those inside it, and the first
    circle with ``k`` rows is read. Fewer rows than ``k`` with a place give all of
    them. Ties go as in ``radius.nearest``; all rows at the distance of the last one
    are inside the circle.
    """
    radius_km = first_km
    for _ in range(TRIES):
        if radius_job.radius_search(df, lat, lng, lat0, lng0, radius_km).select(F.lit(1)).limit(k).count() >= k:
            break
        radius_km *= WIDER
    else:
        radius_km = _ring_with(df, lat0, lng0, k, lat, lng, radius_km)
    # Ties are told apart to the millimetre, so what lies that little farther out counts as well.
    hits = radius_job.radius_search(df, lat, lng, lat0, lng0, min(radius_km, _EVERYWHERE_KM) + 1e-6)
    return radius_job.nearest(hits, k, tie_break)


def _ring_with(df: DataFrame, lat0: float, lng0: float, k: int, lat: str, lng: str, inner_km: float) -> float:
    """Radius of the first ring around a circle with which there are ``k`` rows (an action); the rings double."""
    distance = great_circle_km(lat, lng, lat0, lng0)
    ring = F.greatest(F.ceil(F.log2(distance / inner_km)), F.lit(0))
    counts = df.filter(F.col(lat).isNotNull() & F.col(lng).isNotNull() & ~F.isnan(distance)).groupBy(ring.alias("ring")).agg(F.count("*").alias("n"))
    found = 0
    for r in sorted(counts.filter("ring IS NOT NULL").collect(), key=lambda r: r["ring"]):
        found += r["n"]
        if found >= k:
            # A row on the very edge of its ring may be counted inside by rounding.
            return inner_km * 2.0 ** r["ring"] * (1 + 1e-9)
    return _EVERYWHERE_KM


def _column_count(band: Column, height: float) -> Column:
    """Columns of a band: as many as have the band's height in width where it is widest, and one at least."""
    low, high = band * height - 90, (band + 1) * height - 90
    widest = F.cos(F.radians(F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(high)))))
    return F.greatest(F.floor(F.lit(360.0 / height) * F.greatest(widest, F.lit(0.0))), F.lit(1)).cast("long")


def _band(lat: Column, height: float) -> Column:
    return F.floor((lat + 90) / height)


def _column(lng: Column, count: Column) -> Column:
    """Column of a longitude; 180 and -180 are one place."""
    return F.pmod(F.floor((lng + 180) / 360 * count), count)


def _on_globe(lat: Column, lng: Column) -> Column:
    return F.coalesce(lat.between(-90.0, 90.0) & lng.between(-180.0, 180.0), F.lit(False))


def _cell_height(radius_km: float, cells: int = 1) -> float:
    return min(90.0, max(1e-4, math.degrees(radius_km / EARTH_RADIUS_KM) / cells))


def celled(df: DataFrame, height: float, lat: str = "start_lat", lng: str = "start_lng") -> DataFrame:
    """Rows on the globe with their cell (``band``, ``col``) in bands of ``height`` degrees."""
    placed = df.filter(_on_globe(F.col(lat), F.col(lng))).withColumn("band", _band(F.col(lat), height))
    return placed.withColumn("col", _column(F.col(lng), _column_count(F.col("band"), height)))


def _reach(radius_km: float) -> float:
    """How far a circle reaches north and south, in degrees."""
    return math.degrees(radius_km / EARTH_RADIUS_KM) + _SLACK_DEG


def _half_width(lat: Column, radius_km: float) -> Column:
    """How far a circle reaches east and west, in degrees; at a pole all the way round."""
    share = F.lit(math.sin(min(radius_km / EARTH_RADIUS_KM, math.pi / 2))) / F.cos(F.radians(lat))
    inside = F.degrees(F.asin(F.least(share, F.lit(1.0)))) + _SLACK_DEG
    return F.when(F.abs(lat) + _reach(radius_km) >= 90.0, F.lit(180.0)).otherwise(inside)


def covering(centres: DataFrame, radius_km: float, height: float, lat: str = "lat0", lng: str = "lng0") -> DataFrame:
    """Each centre with every cell (``band``, ``col``) that its circle may touch, each cell once."""
    reach = _reach(radius_km)
    first = F.greatest(_band(F.col(lat) - reach, height), F.lit(0))
    last = F.least(_band(F.col(lat) + reach, height), F.lit(math.ceil(180.0 / height)))
    bands = centres.filter(_on_globe(F.col(lat), F.col(lng))).withColumn("band", F.explode(F.sequence(first, last)))
    count = _column_count(F.col("band"), height)
    half = _half_width(F.col(lat), radius_km)
    west = F.floor((F.col(lng) - half + 180) / 360 * F.col("_count"))
    east = F.floor((F.col(lng) + half + 180) / 360 * F.col("_count"))
    # A run of columns, round the globe once at most.
    run = F.sequence(west, F.least(east, west + F.col("_count") - 1))
    cols = bands.withColumn("_count", count).withColumn("_at", F.explode(run))
    return cols.withColumn("col", F.pmod(F.col("_at"), F.col("_count"))).drop("_count", "_at")


def _spread_dense(rows: DataFrame, circles: DataFrame, dense_rows: int, key: Column) -> tuple[DataFrame, DataFrame]:
    """A part number on both sides, so that a dense cell's rows go to several tasks and its circles to each of these."""
    counts = rows.groupBy("band", "col").agg(F.count("*").alias("n")).filter(F.col("n") > dense_rows)
    dense = written(counts.select("band", "col", F.ceil(F.col("n") / dense_rows).cast("int").alias("parts")), "dense-cells")
    if dense.isEmpty():
        return rows.withColumn("part", F.lit(0)), circles.withColumn("part", F.lit(0))
    known = F.broadcast(dense) if dense.count() <= MOST_DENSE_CELLS else dense
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(known, ["band", "col"], "left").withColumn("part", F.pmod(key, parts).cast("int")).drop("parts")
    copied = circles.join(known, ["band", "col"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return dealt, copied


def _in_blocks(rows: DataFrame, circles: DataFrame, block_rows: int, block_circles: int) -> tuple[DataFrame, DataFrame]:
    """Rows of one place as a list, and circles, both with the block (``part``, ``turn``) in which they meet (two actions).

    A cell's rows are dealt to parts and its circles to turns, so that no block
    holds many of either; each part goes to every turn and each turn to every
    part. Cells without a circle are left out.
    """
    n, m = (df.groupBy("band", "col").agg(F.count("*").alias(name)) for df, name in ((rows, "rows"), (circles, "circles")))
    cells = n.join(m, ["band", "col"]).select(
        "band",
        "col",
        (F.col("rows") * F.col("circles")).alias("pairs"),
        F.ceil(F.col("rows") / block_rows).cast("int").alias("parts"),
        F.ceil(F.col("circles") / block_circles).cast("int").alias("turns"),
    )
    cells = written(cells, "cells-met")
    met = cells.agg(F.count("*").alias("cells"), F.sum(F.col("pairs").cast("double")).alias("pairs")).first()
    known = F.broadcast(cells.drop("pairs")) if met["cells"] <= MOST_DENSE_CELLS else cells.drop("pairs")
    block = ["band", "col", "part", "turn"]
    spots = (
        rows.join(known, ["band", "col"])
        .withColumn("part", F.pmod(F.xxhash64("_key"), "parts").cast("int"))
        .groupBy("band", "col", "turns", "part", "_lat", "_lng")
        # In structs, as a list leaves out keys that are null.
        .agg(F.collect_list(F.struct("_key")).alias("_keys"))
        .select("band", "col", "part", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "_lat", "_lng", F.col("_keys._key").alias("_keys"))
    )
    asked = (
        circles.join(known, ["band", "col"])
        .withColumn("turn", F.pmod(F.xxhash64("_centre", "_lat0", "_lng0"), "turns").cast("int"))
        .select("_centre", "_lat0", "_lng0", "band", "col", "turn", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    )
    # Few bytes make many pairs, so the number of tasks goes by the pairs.
    tasks = min(MOST_TASKS, 1 + int((met["pairs"] or 0) // TASK_PAIRS))
    return spots.repartition(tasks, *block), asked


def rows_around(
    df: DataFrame,
    centres: DataFrame,
    radius_km: float,
    centre: str,
    key: str,
    lat: str = "start_lat",
    lng: str = "start_lng",
    lat0: str = "lat0",
    lng0: str = "lng0",
    dense_rows: int = BLOCK_ROWS,
    dense_circles: int = BLOCK_CIRCLES,
    shown: Callable[[Column], Column] = lambda distance: distance,
) -> DataFrame:
    """(``centre``, ``key``, ``distance_km``) of all rows within the radius of each centre, each pair once (a few actions, then lazy).

    Rows and centres without a place on the globe have no surroundings. The
    distance is worked out, and made what is ``shown``, once for all rows at a
    place. ``key`` should tell rows apart, as dense cells are dealt by its hash.
    """
    height = _cell_height(radius_km)
    rows = celled(df.select(F.col(key).alias("_key"), F.col(lat).alias("_lat"), F.col(lng).alias("_lng")), height, "_lat", "_lng")
    circles = covering(centres.select(F.col(centre).alias("_centre"), F.col(lat0).alias("_lat0"), F.col(lng0).alias("_lng0")), radius_km, height, "_lat0", "_lng0")
    # Written first, as rows are counted per cell and then dealt.
    spots, asked = _in_blocks(written(rows, "celled-rows"), circles, dense_rows, dense_circles)
    distance = great_circle_km("_lat", "_lng", F.col("_lat0"), F.col("_lng0"))
    asked = asked.withColumn("_half", _half_width(F.col("_lat0"), radius_km))
    # Plain comparisons first, so that the trigonometry runs on few pairs that are not listed.
    east = F.abs(F.pmod(F.col("_lng") - F.col("_lng0") + 180, F.lit(360.0)) - 180)
    in_box = (F.abs(F.col("_lat") - F.col("_lat0")) <= _reach(radius_km)) & (east <= F.col("_half"))
    met = spots.join(asked, ["band", "col", "part", "turn"]).filter(in_box & (distance <= float(radius_km)))
    # In a step of its own: next to ``explode`` it would be worked out for every row.
    placed = met.select("_centre", "_keys", shown(distance).alias("distance_km"))
    return placed.select(F.col("_centre").alias(centre), F.explode("_keys").alias(key), "distance_km")


def counts_around(
    df: DataFrame,
    centres: DataFrame,
    radius_km: float,
    centre: str,
    lat: str = "start_lat",
    lng: str = "start_lng",
    lat0: str = "lat0",
    lng0: str = "lng0",
    fine: int = FINE,
    dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    """(``centre``, ``incidents``): rows within the radius of each centre, 0 for none (several actions, then lazy).

    Rows at one place count as one with a weight. Cells that lie wholly inside a
    circle give their total; distances are worked out for the places of the cells
    on its rim alone. No list of pairs is kept: partial counts form where cells
    and circles meet.
    """
    height = _cell_height(radius_km, fine)
    places = df.groupBy(F.col(lat).alias("_lat"), F.col(lng).alias("_lng")).agg(F.count("*").alias("weight"))
    places = written(celled(places, height, "_lat", "_lng"), "weighted-places")
    totals = places.groupBy("band", "col").agg(F.sum("weight").alias("total"))
    asked = centres.select(F.col(centre).alias("_centre"), F.col(lat0).alias("_lat0"), F.col(lng0).alias("_lng0"))
    circles = covering(asked, radius_km, height, "_lat0", "_lng0").withColumn("inside", _cell_inside(height, radius_km))
    circles = written(circles, "circles")
    from_cells = circles.filter("inside").join(totals, ["band", "col"]).groupBy("_centre").agg(F.sum("total").alias("n"))
    rim, touched = _spread_dense(places, circles.filter("NOT inside"), dense_rows, F.xxhash64("_lat", "_lng"))
    distance = great_circle_km("_lat", "_lng", F.col("_lat0"), F.col("_lng0"))
    from_rim = touched.join(rim, ["band", "col", "part"]).filter(distance <= float(radius_km)).groupBy("_centre").agg(F.sum("weight").alias("n"))
    none = asked.select("_centre", F.lit(0).cast("long").alias("n"))
    found = from_cells.unionByName(from_rim).unionByName(none)
    return found.groupBy(F.col("_centre").alias(centre)).agg(F.sum("n").alias("incidents"))


def _cell_inside(height: float, radius_km: float) -> Column:
    """Whether a cell lies wholly within the radius: its middle is nearer than the radius by more than the cell reaches.

    From its middle a cell reaches at most half its height north or south and,
    along its widest parallel, half its width east or west.
    """
    count = _column_count(F.col("band"), height)
    low, high = F.col("band") * height - 90, (F.col("band") + 1) * height - 90
    middle_lat, middle_lng = (low + high) / 2, (F.col("col") + 0.5) / count * 360 - 180
    widest = F.cos(F.radians(F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(high)))))
    reach_km = F.radians(F.lit(height / 2) + 180 / count * widest) * EARTH_RADIUS_KM
    to_middle = great_circle_km(middle_lat, middle_lng, F.col("_lat0"), F.col("_lng0"))
    return (to_middle + reach_km) * (1 + 1e-9) <= float(radius_km)
