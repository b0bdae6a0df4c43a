import itertools
import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from roadpulse.functions.geo import great_circle_km, may_be_within
from roadpulse.functions.routes import highway, normalise_route
from roadpulse.functions.timecols import day_type, elapsed_seconds, parse_time
from roadpulse.operators.radius import hit_count, nearest, radius_search


def _km(spark, lat, lng, lat0, lng0):
    df = spark.createDataFrame([(lat, lng)], "lat double, lng double")
    return df.select(great_circle_km("lat", "lng", lat0, lng0)).first()[0]


@pytest.mark.parametrize(
    "lat, lng, lat0, lng0, km",
    [
        (10.0, 20.0, 10.0, 20.0, 0.0),
        (0.0, 0.0, 0.0, 1.0, 6371.0 * math.pi / 180),
        (0.0, 179.5, 0.0, -179.5, 6371.0 * math.pi / 180),
        (90.0, 0.0, -90.0, 0.0, 6371.0 * math.pi),
        (34.05, -118.24, 40.7128, -74.006, 3935.9),
    ],
)
def test_great_circle(spark, lat, lng, lat0, lng0, km):
    assert _km(spark, lat, lng, lat0, lng0) == pytest.approx(km, abs=0.5 if km > 3000 and km < 4000 else 1e-6)


def test_antipodes_are_numbers(spark):
    """The haversine of many antipodal pairs passes 1 by float error."""
    pts = [(a / 7.0, b / 3.0) for a in range(-600, 600, 37) for b in range(-500, 500, 31)]
    df = spark.createDataFrame(pts, "lat double, lng double")
    km = df.select(great_circle_km("lat", "lng", -F.col("lat"), F.col("lng") + 180).alias("km"))
    assert km.filter(F.isnan("km") | (F.abs(F.col("km") - 6371.0 * math.pi) > 1e-3)).count() == 0


WORLD = [(lat, lng) for lat in [x / 2 for x in range(-180, 181, 5)] for lng in [x / 2 for x in range(-360, 361, 5)]]


@pytest.mark.parametrize(
    "lat0, lng0, km",
    [
        (34.05, -118.24, 500.0),
        (0.0, 179.9, 800.0),
        (10.0, -179.9, 800.0),
        (89.0, 30.0, 400.0),
        (-85.0, 30.0, 900.0),
        (20.0, 0.0, 12000.0),
        (20.0, 0.0, 30000.0),
        (0.0, 0.0, 0.0),
    ],
)
def test_box_loses_no_hit(spark, lat0, lng0, km):
    df = spark.createDataFrame([*WORLD, (34.0, 241.76), (None, 1.0), (1.0, None)], "lat double, lng double")
    boxed = radius_search(df, "lat", "lng", lat0, lng0, km)
    plain = df.filter(great_circle_km("lat", "lng", lat0, lng0) <= km)
    assert boxed.count() == plain.count()
    assert boxed.select("lat", "lng").exceptAll(plain).isEmpty()


def test_no_place_is_never_a_hit(spark):
    """Null, NaN and infinite coordinates, whatever the radius."""
    odd = [None, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(a, b) for a in [*odd, 1.0] for b in odd] + [(a, 1.0) for a in odd], "lat double, lng double")
    assert radius_search(df, "lat", "lng", 1.0, 1.0, 30000.0).isEmpty()
    assert df.filter("lat IS NULL OR lng IS NULL").filter(great_circle_km("lat", "lng", 0.0, 0.0).isNotNull()).isEmpty()


def test_box_is_selective(spark):
    df = spark.createDataFrame(WORLD, "lat double, lng double")
    assert df.filter(may_be_within("lat", "lng", 34.05, -118.24, 500.0)).count() < 50


def test_radius_is_inclusive(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "lat double, lng double")
    exact = df.select(great_circle_km("lat", "lng", 0.0, 0.0)).first()[0]
    assert hit_count(radius_search(df, "lat", "lng", 0.0, 0.0, exact)).first()["incidents"] == 1
    assert radius_search(df, "lat", "lng", 0.0, 0.0, math.nextafter(exact, 0)).isEmpty()


def test_nearest_orders_and_breaks_ties(spark):
    df = spark.createDataFrame([(3, 0.0, 2.0), (2, 0.0, 1.0), (1, 0.0, -1.0)], "id long, lat double, lng double")
    hits = radius_search(df, "lat", "lng", 0.0, 0.0, 500.0)
    assert [r["id"] for r in nearest(hits, 2, "id").collect()] == [1, 2]
    assert [r["id"] for r in nearest(hits).collect()][2] == 3


STREETS = {
    "I- 95 N": "I-95",
    "I-95": "I-95",
    "I - 95": "I-95",
    "i-5": "I-5",
    "I 5": "I-5",
    "US 101": "US-101",
    "us - 101": "US-101",
    "Business US 30": "US-30",
    "Hawaii 5 Hwy": "I-5",
    "Interstate 80": "Interstate 80",
    "I80": "I80",
    "Main St": "Main St",
    "US-30 / I-80": "US-30",
    "": "",
}


def test_routes(spark):
    df = spark.createDataFrame([(s,) for s in STREETS], "street string")
    got = {r["street"]: r["route"] for r in df.withColumn("route", normalise_route("street")).collect()}
    assert got == STREETS


def _blanks(text, at):
    while at < len(text) and text[at] in " \t":
        at += 1
    return at


def _route_by_hand(street):
    """Letters, then a dash or some blanks (or both), then a number; first place wins."""
    text = street.upper()
    for at in range(len(text)):
        system = next((s for s in ("I", "US") if text.startswith(s, at)), None)
        if system is None:
            continue
        after = at + len(system)
        number = _blanks(text, after)
        if text[number : number + 1] == "-":
            number = _blanks(text, number + 1)
        elif number == after:
            continue
        digits = "".join(itertools.takewhile(str.isdigit, text[number:]))
        if digits:
            return f"{system}-{digits}"
    return street


def test_routes_of_random_streets(spark):
    rnd = random.Random(11)
    streets = {"".join(rnd.choices(["I", "i", "US", "us", "-", " ", "  ", "\t", "5", "10", "x"], k=rnd.randint(1, 9))) for _ in range(6000)}
    df = spark.createDataFrame([(s,) for s in streets], "street string")
    got = {r["street"]: r["route"] for r in df.withColumn("route", normalise_route("street")).collect()}
    assert got == {s: _route_by_hand(s) for s in streets}
    assert sum(got[s] != s for s in streets) > 500


def test_anchored_route_needs_a_word_start(spark):
    df = spark.createDataFrame([("Hawaii 5 Hwy",), ("Old I-5",), (None,)], "street string")
    got = [r[0] for r in df.select(highway("street", anchored=True)).collect()]
    assert got == [None, "I-5", None]


def test_times(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-05 10:00:00", "2024-01-05 10:30:00"),
            ("2024-01-06 10:00:00.9", "2024-01-06 10:00:02.1"),
            ("2024-01-07 23:59:59.999999", "2024-01-08"),
            ("2016-02-08 00:37:08.000000000", "2016-02-08 06:37:08"),
            ("not a date", "2024-01-08 00:00:00"),
            (None, None),
        ],
        "s string, e string",
    )
    start, end = parse_time("s"), parse_time("e")
    rows = df.select(start.alias("ts"), elapsed_seconds(start, end).alias("sec"), day_type(start).alias("d")).collect()
    assert [r["sec"] for r in rows] == [1800, 2, 1, 21600, None, None]
    assert [r["d"] for r in rows] == ["weekday", "weekend", "weekend", "weekday", "unknown", "unknown"]
    assert rows[0]["ts"] == datetime(2024, 1, 5, 10)


def test_zone_of_the_session_moves_nothing(spark):
    """A local time that daylight saving skips keeps its day and its length."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 01:30:00", "2024-03-10 03:30:00")], "s string, e string")
        start, end = parse_time("s"), parse_time("e")
        row = df.select(F.to_date(start), elapsed_seconds(start, end), day_type(start)).first()
        assert tuple(row) == (date(2024, 3, 10), 7200, "weekend")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
