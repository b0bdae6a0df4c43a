"""A history that grows, against one worked out at once."""

import math
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import anomaly, history

SCHEMA = "state string, start_time string, precipitation_in double, visibility_mi double"


def incidents(seed, n, states=3, days=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = rng.randint(1, days) if i % 5 else 7
        when = None if i % 31 == 0 else "bad" if i % 37 == 0 else f"2024-{1 + day // 28:02d}-{1 + day % 28:02d} 10:00:00"
        rows.append((None if i % 29 == 0 else f"S{rng.randrange(states)}", when, rng.choice([None, rng.random()]), 1.5))
    return rows


def whole(spark, rows):
    daily = anomaly.daily_rollup(spark.createDataFrame(rows, SCHEMA))
    stats = {r["state"]: (r["observed_days"], r["hist_mean"], r["hist_std"]) for r in anomaly.entity_history(daily).collect()}
    return stats, found(anomaly.sigma_anomalies(daily, sigmas=1.0))


def found(df):
    names = ["state", "day", "day_incidents", "mean_precipitation", "mean_visibility", "hist_mean", "hist_std", "threshold"]
    assert set(df.columns) == set(names)
    return {(r["state"], r["day"]): tuple(r[n] for n in names[2:]) for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k, values in want.items():
        assert [pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for v in values] == list(got[k]), k


def kept_stats(kept):
    return {r["state"]: (r["n"], r["mean"], math.sqrt(r["m2"] / (r["n"] - 1)) if r["n"] > 1 else None) for r in kept.moments().collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_what_the_whole_gives(spark, tmp_path, seed):
    rows = incidents(seed, 900)
    rng = random.Random(seed)
    cuts = [0, *sorted(rng.sample(range(900), 3)), 900]
    kept = history.History(spark, str(tmp_path / "h"))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        kept.absorb(spark.createDataFrame(rows[a:b], SCHEMA))
        if k == 1:
            kept.compact()
            kept.prune()
        stats, days = whole(spark, rows[:b])
        same(kept_stats(kept), stats)
        same(found(kept.anomalies(sigmas=1.0)), days)
    assert days
    late = {k: v for k, v in days.items() if str(k[1]) >= "2024-02-01"}
    same(found(kept.anomalies(sigmas=1.0, since="2024-02-01")), late)


def test_an_update_that_died_is_replaced(spark, tmp_path):
    rows = incidents(3, 300)
    kept = history.History(spark, str(tmp_path / "h"))
    assert kept.version() == 0
    kept.absorb(spark.createDataFrame(rows[:200], SCHEMA))
    # Days of a second version without its moments.
    history.day_sums(spark.createDataFrame(rows[:50], SCHEMA)).write.parquet(str(tmp_path / "h" / "days" / "2"))
    assert kept.version() == 1
    same(kept_stats(kept), whole(spark, rows[:200])[0])
    assert kept.absorb(spark.createDataFrame(rows[200:], SCHEMA)) == 2
    same(kept_stats(kept), whole(spark, rows)[0])


def test_nothing_new_and_nothing_at_all(spark, tmp_path):
    kept = history.History(spark, str(tmp_path / "h"))
    none = spark.createDataFrame([(None, "2024-01-01 00:00:00", 1.0, 1.0), ("S1", "bad", 1.0, 1.0)], SCHEMA)
    kept.absorb(none)
    assert kept.moments().isEmpty() and kept.anomalies().isEmpty()
    rows = incidents(4, 200)
    kept.absorb(spark.createDataFrame(rows, SCHEMA))
    kept.absorb(none)
    same(kept_stats(kept), whole(spark, rows)[0])


def test_moments_come_apart_as_they_were_put_together(spark):
    schema = "state string, n long, mean double, m2 double"
    one = spark.createDataFrame([("a", 3, 2.0, 2.0), ("b", 1, 5.0, 0.0)], schema)
    two = spark.createDataFrame([("a", 2, 7.0, 8.0), ("c", 4, 1.0, 6.0)], schema)
    both = history.merged(one, two)
    assert {r["state"]: tuple(r)[1:] for r in both.collect()} == {"a": (5, 4.0, 40.0), "b": (1, 5.0, 0.0), "c": (4, 1.0, 6.0)}
    left = history.merged(both, two, sign=-1)
    assert {r["state"]: tuple(r)[1:] for r in left.collect()} == {"a": (3, pytest.approx(2.0), pytest.approx(2.0)), "b": (1, 5.0, 0.0)}


def test_only_days_near_the_new_ones_are_looked_up(spark, tmp_path):
    kept = history.History(spark, str(tmp_path / "h"))
    kept.absorb(spark.createDataFrame(incidents(5, 200), SCHEMA))
    days = kept._day_rows().filter(F.col("day").between(F.lit("2024-03-01").cast("date"), F.lit("2024-03-02").cast("date")))
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(day), GreaterThanOrEqual(day" in plan
