"""The space-filling curve, and what a table laid along it spares."""

import glob
import math
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from roadpulse.functions.curve import curve_key, interleaved
from roadpulse.functions.geo import bounding_box
from roadpulse.sources import layout


def test_bits_in_turn(spark):
    rng = random.Random(3)
    pairs = [(0, 0), (1, 0), (0, 1), ((1 << 31) - 1, 0), (0, (1 << 31) - 1)] + [(rng.getrandbits(31), rng.getrandbits(31)) for _ in range(50)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", interleaved(F.col("a"), F.col("b")).alias("k")).collect()
    for r in got:
        assert r["k"] == sum((r["a"] >> i & 1) << 2 * i | (r["b"] >> i & 1) << 2 * i + 1 for i in range(31))


def test_places_without_a_key(spark):
    odd = [(None, 0.0), (0.0, None), (math.nan, 0.0), (0.0, math.inf), (90.1, 0.0), (0.0, -180.1)]
    edge = [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)]
    rows = spark.createDataFrame(odd + edge, "lat double, lng double").select(curve_key("lat", "lng").alias("k"))
    keys = [r["k"] for r in rows.collect()]
    assert keys[: len(odd)] == [None] * len(odd)
    assert keys[len(odd) :] == [(1 << 52) - 1, 0, 3 << 50]


def _places(spark, n=6000):
    """Places of many states all over one region, a third of them at one point."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        lat, lng = (34.0, -118.0) if i % 3 == 0 else (rng.uniform(30, 40), rng.uniform(-120, -110))
        rows.append((i, f"S{rng.randrange(50)}", None if i % 97 == 0 else lat, lng))
    return spark.createDataFrame(rows, "id long, state string, start_lat double, start_lng double")


def test_row_group_zones_are_those_of_the_footers(spark, tmp_path):
    table = layout.write_along_curve(_places(spark), str(tmp_path / "t"), partitions=4, rows_per_group=300)
    assert table.keys == ("start_lat", "start_lng")
    zones = {
        (r["file_name"], r["row_group"]): (r["rows"], r["min_start_lat"], r["max_start_lat"])
        for r in layout.row_group_zones(spark, table, ["start_lat"], 300).collect()
    }
    want = {}
    for path in glob.glob(f"{table.path}/*.parquet"):
        footer = pq.ParquetFile(path).metadata
        at = footer.schema.to_arrow_schema().get_field_index("start_lat")
        for k in range(footer.num_row_groups):
            group = footer.row_group(k)
            stats = group.column(at).statistics
            bounds = (stats.min, stats.max) if stats.has_min_max else (None, None)
            want[path.rsplit("/", 1)[1], k] = (group.num_rows, *bounds)
    assert zones == want
    assert len(want) >= 20
    assert "_curve" not in layout.read_clustered(spark, table).columns


def test_fewer_row_groups_for_a_box_without_a_state(spark, tmp_path):
    places = _places(spark)
    by_state = layout.write_clustered(places, str(tmp_path / "s"), ("state", "start_lat"), partitions=4, rows_per_group=100)
    along = layout.write_along_curve(places, str(tmp_path / "c"), partitions=4, rows_per_group=100)
    latitudes, longitudes = bounding_box(36.0, -112.0, 40.0)
    box = {"start_lat": latitudes, "start_lng": longitudes[0]}
    hits = places.filter(F.col("start_lat").between(*latitudes) & F.col("start_lng").between(*longitudes[0])).count()
    opened = []
    for table in (by_state, along):
        found = layout.opened_by_box(layout.row_group_zones(spark, table, list(box), 100), box).first()
        assert found["rows"] == 6000
        assert found["rows_opened"] >= hits > 0
        opened.append(found["groups_opened"])
    assert 5 * opened[1] < opened[0]


def test_a_hot_place_is_spread_over_files(spark, tmp_path):
    table = layout.write_along_curve(_places(spark), str(tmp_path / "t"), partitions=6)
    sizes = sorted(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{table.path}/*.parquet"))
    assert len(sizes) == 6 and sizes[-1] < 1700
    assert layout.read_clustered(spark, table).count() == 6000


def test_bounding_box_at_the_seam_and_the_pole():
    assert bounding_box(0.0, 179.9, 50.0)[1][0][1] == 180.0 and len(bounding_box(0.0, 179.9, 50.0)[1]) == 2
    assert bounding_box(89.9, 0.0, 50.0)[1] == [(-180.0, 180.0)]
