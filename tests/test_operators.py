import random
import statistics
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal
from math import asin, cos, radians, sin, sqrt

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import anomaly, clearance, hotspots, profile, route_ranking
from roadpulse.sources import shared_dir


def _half_up(x, places=2):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def test_grid_rounds_half_up_and_leaves_nulls_out(spark):
    df = spark.createDataFrame(
        [(0.125, 10.0, 3), (0.13, 10.0, 4), (0.12, 10.0, 3), (None, 10.0, 4), (0.125, None, 4), (0.125, 10.0, 2)],
        "start_lat double, start_lng double, severity long",
    )
    rows = hotspots.grid_hotspots(df).collect()
    assert [(r["lat_cell"], r["incidents"]) for r in rows] == [(0.13, 2), (0.12, 1)]


def test_top_cells_tie_goes_by_cell(spark):
    df = spark.createDataFrame(
        [(float(i), 0.0, 3) for i in (7, 3, 5, 1, 9, 2)], "start_lat double, start_lng double, severity long"
    )
    assert [r["lat_cell"] for r in hotspots.grid_hotspots(df).collect()] == [1.0, 2.0, 3.0, 5.0, 7.0]


def test_weighted_cells(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 1)] * 5 + [(2.0, 2.0, 4)] * 2, "start_lat double, start_lng double, severity long"
    )
    cells = hotspots.grid_cells(df, weight="severity")
    assert hotspots.top_cells(cells, 1).first()["lat_cell"] == 1.0
    top = hotspots.top_cells(cells, 1, by="danger").first()
    assert (top["lat_cell"], top["danger"], top["incidents"]) == (2.0, 8, 2)


def _distance(a, b):
    p, q = radians(a[0]), radians(b[0])
    h = sin((q - p) / 2) ** 2 + cos(p) * cos(q) * sin(radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * asin(sqrt(min(1.0, h)))


def _places(kind):
    rnd = random.Random(kind)
    if kind == "city":
        pts = [(34 + rnd.random() / 10, -118 + rnd.random() / 10) for _ in range(300)]
        return pts + [(34.055, -117.945)] * 200
    if kind == "date line":
        return [(rnd.uniform(-0.05, 0.05), rnd.choice([1, -1]) * (180 - rnd.random() / 20)) for _ in range(200)] + [
            (0.0, 180.0),
            (0.0, -180.0),
        ]
    return [(65 + rnd.random() / 20, 20 + rnd.random() / 10) for _ in range(200)]


@pytest.mark.parametrize("kind", ["city", "date line", "north"])
@pytest.mark.parametrize("km", [0.3, 2.0, 5.0])
def test_radius_hotspots_equal_brute_force(spark, kind, km):
    pts = _places(kind)
    df = spark.createDataFrame(pts, "start_lat double, start_lng double")

    def wrap(x):
        return -180.0 if x == 180.0 else x

    centres = {(_half_up(a), wrap(_half_up(b))) for a, b in pts}
    want = {c: sum(_distance(c, p) <= km for p in pts) for c in centres}
    got = {(r["lat_cell"], r["lng_cell"]): r["incidents"] for r in hotspots.cells_within_radius(df, km).collect()}
    assert got == want


@pytest.mark.parametrize("km", [15_000.0, 25_000.0])
def test_radius_hotspots_with_a_world_wide_radius(spark, km):
    pts = [(10.0, 20.0), (-10.0, -160.0), (50.0, 170.0), (-80.0, 0.0)]
    df = spark.createDataFrame(pts, "start_lat double, start_lng double")
    want = {c: sum(_distance(c, p) <= km for p in pts) for c in pts}
    cells = hotspots.cells_within_radius(df, km, decimals=0).collect()
    assert {(r["lat_cell"], r["lng_cell"]): r["incidents"] for r in cells} == want


def test_off_range_rows_are_left_out_and_can_be_seen(spark):
    df = spark.createDataFrame([(10.0, 20.0), (95.0, 20.0), (10.0, -190.0), (None, 1.0)], "start_lat double, start_lng double")
    assert [tuple(r) for r in hotspots.cells_within_radius(df).collect()] == [(10.0, 20.0, 1)]
    assert sorted(tuple(r) for r in df.filter(hotspots.off_range()).collect()) == [(10.0, -190.0), (95.0, 20.0)]
    assert hotspots.grid_cells(df).count() == 3


def test_radius_hotspots_over_a_pole(spark):
    df = spark.createDataFrame([(89.995, 10.0), (89.995, -170.0), (None, 1.0)], "start_lat double, start_lng double")
    cells = hotspots.cells_within_radius(df, 2.0, decimals=1).collect()
    # Both round to latitude 90, the same place under two longitudes.
    assert [(r["lat_cell"], r["incidents"]) for r in cells] == [(90.0, 2), (90.0, 2)]


def test_route_totals(spark):
    rows = [
        ("I-5 N", 3, "2024-01-01 00:00:00", "2024-01-01 00:10:00"),
        ("i 5", 4, "2024-01-01 00:00:00", "2024-01-01 00:20:00"),
        ("I- 5", 4, "bad", "2024-01-01 00:20:00"),
        ("I-5", 2, "2024-01-01 00:00:00", "2024-01-01 09:00:00"),
        ("Main St", 3, None, None),
        ("MAIN ST", 3, "2024-01-01 00:00:00", "2024-01-01 00:01:00"),
        (None, 4, "2024-01-01 00:00:00", "2024-01-01 00:01:00"),
    ]
    df = spark.createDataFrame(rows, "street string, severity long, start_time string, end_time string")
    got = {r["route"]: (r["incidents"], r["mean_clearance_min"]) for r in route_ranking.route_totals(df).collect()}
    assert got == {"I-5": (3, 15.0), "Main St": (1, None), "MAIN ST": (1, 1.0)}
    only = route_ranking.route_totals(df, highways_only=True).collect()
    assert [r["route"] for r in only] == ["I-5"]
    ranking = route_ranking.route_ranking(route_ranking.route_totals(df), 2).collect()
    assert [r["route"] for r in ranking] == ["I-5", "MAIN ST"]


def _daily(spark, counts):
    rows = [(state, f"2024-01-{i + 1:02d}", n) for state, ns in counts.items() for i, n in enumerate(ns)]
    return spark.createDataFrame(rows, "state string, day string, day_incidents long")


def test_both_forms_of_anomalies_agree(spark):
    rnd = random.Random(5)
    counts = {f"S{i}": [rnd.randint(5, 9) for _ in range(28)] + [rnd.choice([8, 20, 40])] for i in range(12)}
    counts["single"] = [100]
    counts["flat"] = [4] * 20
    daily = _daily(spark, counts)
    window = anomaly.sigma_anomalies(daily, form="window")
    written = shared_dir.written(daily, "daily")
    join = anomaly.sigma_anomalies(written, form="join")

    def key(df):
        return {(r["state"], r["day"]) for r in df.collect()}

    want = set()
    for state, ns in counts.items():
        if len(ns) > 1:
            limit = statistics.mean(ns) + 3 * statistics.stdev(ns)
            want |= {(state, f"2024-01-{i + 1:02d}") for i, n in enumerate(ns) if n > limit}
    assert key(window) == key(join) == want
    assert want
    assert anomaly.anomaly_count(window).first()[0] == len(want)
    with pytest.raises(ValueError):
        anomaly.sigma_anomalies(daily, form="other")


def test_top_days_ties(spark):
    df = _daily(spark, {"B": [3, 3], "A": [3, 1], "C": [9, 0]})
    rows = anomaly.top_days(df, 3).collect()
    assert [(r["state"], r["day"]) for r in rows] == [("C", "2024-01-01"), ("A", "2024-01-01"), ("B", "2024-01-01")]


ROWS = [
    ("X", "2024-01-01 10:00:00", 1.0, None),
    ("X", "2024-01-01 23:59:59.9", None, 4.0),
    ("X", "2024-01-02 00:00:00", 2.0, 5.0),
    ("X", "garbage", 9.0, 9.0),
    ("X", None, 9.0, 9.0),
    (None, "2024-01-01 10:00:00", 9.0, 9.0),
]


def test_daily_rollup(spark):
    df = spark.createDataFrame(ROWS, "state string, start_time string, precipitation_in double, visibility_mi double")
    parsed = {str(r["day"]): tuple(r)[2:] for r in anomaly.daily_rollup(df).collect()}
    assert parsed == {"2024-01-01": (2, 1.0, 4.0), "2024-01-02": (1, 2.0, 5.0)}
    prefix = {r["day"]: tuple(r)[2:] for r in anomaly.daily_rollup(df, day_from="prefix").collect()}
    assert prefix == {**parsed, "garbage": (1, 9.0, 9.0)}
    with pytest.raises(ValueError):
        anomaly.daily_rollup(df, day_from="hour")


def test_clearance(spark):
    rows = [
        ("Day", "2024-01-05 10:00:00", "2024-01-05 10:10:00"),
        ("Day", "2024-01-05 11:00:00", "2024-01-05 11:20:00"),
        ("Day", "2024-01-06 10:00:00", "2024-01-06 10:05:00"),
        ("Night", "2024-01-05 01:00:00", "2024-01-05 00:30:00"),
        ("Night", "oops", "2024-01-05 00:30:00"),
        (None, "2024-01-05 01:00:00", "2024-01-05 09:30:00"),
    ]
    df = spark.createDataFrame(rows, "sunrise_sunset string, start_time string, end_time string")
    got = [tuple(r) for r in clearance.clearance_by(df).collect()]
    assert got == [
        ("Day", "weekday", 15.0, 2),
        ("Day", "weekend", 5.0, 1),
        ("Night", "unknown", None, 1),
        ("Night", "weekday", -30.0, 1),
    ]
    folded = [tuple(r) for r in clearance.clearance_by(df, unknown="weekday").collect()]
    assert folded[-1] == ("Night", "weekday", -30.0, 2)


def test_profile_and_sample(spark):
    df = spark.createDataFrame([(2, None, float("nan")), (1, "x", None)], "`a(b)` long, c string, `d.e` double")
    got = [tuple(r) for r in profile.column_profile(df).orderBy("ordinal").collect()]
    assert got == [(0, "a(b)", "bigint", 2), (1, "c", "string", 1), (2, "d.e", "double", 1)]
    assert [r[0] for r in profile.sample_head(df, order="a(b)", n=1).collect()] == [1]
    assert profile.sample_head(spark.range(100)).count() == 5


def test_hot_key_results_stay_whole(spark):
    """A third of all rows on one cell, street and state: nothing is lost."""
    n = 30_000
    df = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.rand(1) * 50).alias("start_lat"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.rand(2) * 50).alias("start_lng"),
        F.lit(3).cast("long").alias("severity"),
        F.when(F.col("id") % 3 == 0, "I-5").otherwise(F.concat(F.lit("St "), F.col("id") % 997)).alias("street"),
        F.lit("2024-01-01 00:00:00").alias("start_time"),
        F.lit("2024-01-01 00:30:00").alias("end_time"),
    )
    assert hotspots.grid_cells(df).agg(F.sum("incidents")).first()[0] == n
    totals = route_ranking.route_totals(df)
    assert Counter(r["incidents"] for r in totals.collect())[n // 3] == 1
    assert totals.agg(F.sum("incidents")).first()[0] == n
