"""Nearest rows and surroundings of many centres, against all distances."""

import math
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import nearest
from roadpulse.plans import queries

ODD = [(None, 0.0), (0.0, None), (math.nan, 0.0), (95.0, 0.0), (0.0, 181.0)]
EDGES = [(90.0, 0.0), (-90.0, 17.0), (0.0, 180.0), (0.0, -180.0), (89.99, 100.0), (89.99, -80.0), (0.0, 0.0), (-0.01, 179.99)]


def places(seed, n):
    """All over the globe, at its edges, and a third of them in one spot."""
    rng = random.Random(seed)
    spread = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(n // 3)]
    near = [(rng.gauss(34, 0.3), rng.gauss(-118, 0.3)) for _ in range(n // 3)]
    return EDGES + spread + near + [(34.05, -118.24)] * (n // 3)


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def frame(spark, rows, names):
    schema = f"{names[0]} long, {names[1]} double, {names[2]} double"
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema).repartition(6)


@pytest.mark.parametrize("at", [(34.0, -118.0), (-60.0, 30.0), (90.0, 0.0), (-90.0, 0.0), (0.0, 180.0), (0.0, -179.999)])
@pytest.mark.parametrize("k", [1, 25])
def test_nearest_is_that_of_all_distances(spark, at, k):
    rows = places(1, 300)
    got = nearest.nearest_anywhere(frame(spark, rows + ODD[:3], ("id", "start_lat", "start_lng")), *at, k=k, tie_break="id").collect()
    want = sorted((round(km(r, at), 6), i) for i, r in enumerate(rows))[:k]
    assert [(pytest.approx(d, abs=2e-6), i) for d, i in want] == [(r["distance_km"], r["id"]) for r in got]


def test_fewer_rows_than_asked_for(spark):
    rows = frame(spark, [(10.0, 10.0), (None, 1.0), (-80.0, 170.0)], ("id", "start_lat", "start_lng"))
    assert [r["id"] for r in nearest.nearest_anywhere(rows, 0.0, 0.0).collect()] == [0, 2]
    assert nearest.nearest_anywhere(rows.limit(0), 0.0, 0.0).collect() == []


@pytest.mark.parametrize("radius_km", [0.5, 30.0, 900.0, 12_000.0])
@pytest.mark.parametrize("dense_rows", [20, 10**6])
def test_surroundings_are_those_of_all_pairs(spark, radius_km, dense_rows):
    rows, centres = places(2, 240), EDGES + places(3, 30) + [(34.05, -118.24)]
    df, asked = frame(spark, rows + ODD, ("id", "start_lat", "start_lng")), frame(spark, centres + ODD, ("c", "lat0", "lng0"))
    distances = {(c, i): km(r, p) for c, p in enumerate(centres) for i, r in enumerate(rows)}
    # Rounding decides on the very rim.
    sure = {p for p, d in distances.items() if d <= radius_km - 1e-6}
    maybe = {p for p, d in distances.items() if d <= radius_km + 1e-6}
    pairs = [(r["c"], r["id"]) for r in nearest.rows_around(df, asked, radius_km, "c", "id", dense_rows=dense_rows).collect()]
    assert len(pairs) == len(set(pairs))
    assert sure <= set(pairs) <= maybe
    counts = {r["c"]: r["incidents"] for r in nearest.counts_around(df, asked, radius_km, "c", dense_rows=dense_rows).collect()}
    assert set(counts) == set(range(len(centres) + len(ODD)))
    for c in range(len(centres)):
        assert sum(p[0] == c for p in sure) <= counts[c] <= sum(p[0] == c for p in maybe)
    assert all(counts[len(centres) + k] == 0 for k in range(len(ODD)))


def test_each_cell_once(spark):
    centres = frame(spark, EDGES + [(45.0, 10.0)], ("c", "lat0", "lng0"))
    for radius_km in (1.0, 2500.0, 20_000.0):
        cells = nearest.covering(centres, radius_km, nearest._cell_height(radius_km)).select("c", "band", "col")
        assert cells.count() == cells.distinct().count()


def test_counts_compare_places_on_the_rim_only(spark):
    """Thousands of rows in cells that lie inside a circle meet it as one total."""
    rng = random.Random(4)
    df = frame(spark, [(rng.uniform(33.9, 34.1), rng.uniform(-118.1, -117.9)) for _ in range(5000)], ("id", "start_lat", "start_lng"))
    asked = frame(spark, [(34.0, -118.0)] * 3, ("c", "lat0", "lng0"))
    height = nearest._cell_height(100.0, nearest.FINE)
    inside = nearest.covering(asked, 100.0, height).withColumn("_lat0", F.col("lat0")).withColumn("_lng0", F.col("lng0"))
    inside = inside.withColumn("inside", nearest._cell_inside(height, 100.0))
    met = nearest.celled(df, height).join(inside.filter("NOT inside"), ["band", "col"]).count()
    assert met == 0
    assert {r["incidents"] for r in nearest.counts_around(df, asked, 100.0, "c").collect()} == {5000}


def test_pairs_are_listed_by_even_tasks_and_distances_once_per_place(spark, monkeypatch):
    """Few rows in one file may make many pairs: tasks go by the pairs, and a crowded place costs one distance."""
    monkeypatch.setattr(nearest, "TASK_PAIRS", 20_000)
    spots = [(34.0, -118.0), (34.001, -118.001), (34.0, -118.5)]
    keys = [None if i % 10 == 0 else i // 2 for i in range(900)]
    df = spark.createDataFrame([(k, *spots[i % 3]) for i, k in enumerate(keys)], "id long, start_lat double, start_lng double").coalesce(1)
    asked = frame(spark, [(34.0, -118.0)] * 200 + [(34.0, -118.5)] * 10, ("c", "lat0", "lng0"))
    found = nearest.rows_around(df, asked, 2.0, "c", "id", dense_rows=100, dense_circles=50)
    want = [(c, k) for c in range(200) for i, k in enumerate(keys) if i % 3 < 2] + [(200 + c, k) for c in range(10) for k in keys[2::3]]
    assert sorted(((r["c"], r["id"]) for r in found.collect()), key=str) == sorted(want, key=str)
    assert found.rdd.getNumPartitions() >= len(want) // 20_000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("Generate explode(_keys")
    assert below and "ASIN" not in above


def test_a_shown_distance_is_that_of_decimals(spark):
    rng = random.Random(6)
    middles = [(rng.randrange(10**9) + 0.5) / 10**6 for _ in range(3000)]
    values = [0.0, 5e-7, 4.9e-11, 2.0, 20015.086796, *middles, *(v + rng.uniform(-1e-8, 1e-8) for v in middles), *(rng.uniform(0, 2) for _ in range(3000))]
    df = spark.createDataFrame([(float(v),) for v in values], "km double")
    both = df.select(queries._distance_shown(F.col("km")).alias("a"), F.round(F.round("km", 10), 6).alias("b"))
    assert both.filter("a <> b OR a IS NULL").count() == 0
