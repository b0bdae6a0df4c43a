"""Sketches of parts, merged, against exact values of the whole."""

import random

from roadpulse.operators import sketch_profile as sketch

SCHEMA = "part string, key long, size double, name string, nothing double"


def rows(n=6000):
    rng = random.Random(3)
    out = []
    for i in range(n):
        size = None if i % 11 == 0 else float("nan") if i % 13 == 0 else rng.lognormvariate(0, 2)
        name = "common" if i % 3 == 0 else None if i % 7 == 0 else f"n{rng.randrange(400)}"
        out.append((rng.choice(["a", "b", None]), i, size, name, None))
    return out


def test_merged_parts_hold_for_the_whole(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(6)
    found = sketch.estimates(sketch.merged(sketch.column_sketches(df, by=["part"])))
    held = {r["column_name"]: tuple(r)[2:] for r in sketch.against_exact(df, found).collect()}
    assert {c: v[0] for c, v in held.items()} == {"key": 6000, "size": 6000 - 546, "name": sum(r[3] is not None for r in rows()), "nothing": 0}
    assert all(v[1] and v[3] for v in held.values())
    assert (held["key"][2], held["size"][2], held["name"][2], held["nothing"][2]) == (True, True, None, None)


def test_a_part_more_changes_what_the_whole_says(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    kept = sketch.column_sketches(df.filter("key < 3000"))
    new = sketch.column_sketches(df.filter("key >= 3000"))
    both = {r["column_name"]: r for r in sketch.estimates(sketch.merged(kept.unionByName(new))).collect()}
    once = {r["column_name"]: r for r in sketch.estimates(sketch.column_sketches(df)).collect()}
    for name, r in once.items():
        assert (r["non_null"], r["data_type"]) == (both[name]["non_null"], both[name]["data_type"])
    assert both["name"]["frequent"][0] == once["name"]["frequent"][0] == ("common", 2000)
    assert abs(both["key"]["different"] - 6000) < 300


def test_bounds_that_do_not_hold_are_told(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    half = sketch.estimates(sketch.column_sketches(df.filter("key < 600"), columns=["key", "name"]))
    held = {r["column_name"]: r for r in sketch.against_exact(df, half).collect()}
    assert not held["key"]["different_holds"] and not held["key"]["quantiles_hold"]
    assert not held["name"]["frequent_holds"]


def test_no_rows(spark):
    found = sketch.estimates(sketch.column_sketches(spark.createDataFrame([], SCHEMA))).collect()
    assert [(r["non_null"], r["different"], r["quantiles"], r["frequent"]) for r in found] == [(0, 0, None, [])] * 5


def test_exact_counts_hold_one_column_at_a_time(spark):
    """Counting all columns' different values in one grouping keeps every row once per column in a task."""
    data = [(None, 1, 0.0, "x", None), ("a", 1, -0.0, None, None), ("a", 2, float("nan"), "y", None), ("b", None, None, "", None)]
    df = spark.createDataFrame(data * 3, SCHEMA)
    found = sketch.estimates(sketch.column_sketches(df))
    exact = sketch.against_exact(df, found)
    assert "Expand" not in exact._jdf.queryExecution().optimizedPlan().toString()
    assert all(r["different_holds"] for r in exact.collect())
    assert tuple(sketch._different(df, df.columns).first()) == tuple(df.selectExpr(*[f"count(DISTINCT CAST({c} AS STRING))" for c in df.columns]).first())
