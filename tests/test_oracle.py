"""Every registered query against its SQL, and the contract of the entry file."""

import pytest

import __spark_entry__ as entry_file
import compare
from roadpulse.plans import oracle
from roadpulse.plans import queries as registry

ROWS_ONLY = {"layout_zone_map", "ml_train_predict", "ml_tree_metrics", "ml_prediction_sample"}


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def data(request):
    sf_dir = f"/root/testdata/{request.param}"
    con = compare.connect(sf_dir)
    yield sf_dir, con
    con.close()


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows_as_sql(spark, data, name):
    sf_dir, con = data
    names, rows = compare.spark_rows(entry_file.queries()[name](spark, sf_dir))
    want_names, want = compare.oracle_rows(con, entry_file.oracle_sql()[name])
    assert names == want_names
    assert rows == want


def test_every_query_has_sql_but_the_listed():
    assert set(registry.registered()) - set(oracle.oracle_sql()) == ROWS_ONLY
    assert set(registry.registered()) <= set(entry_file.queries())
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.columns == ["nation", "day", "day_orders", "hist_mean", "hist_std", "threshold"]
    assert df.count() == 22


def test_known_values(spark, small):
    """Values worked out beforehand for this data."""
    q = entry_file.queries()
    assert q["radius_search_near"](spark, small).count() == 794
    first = q["radius_nearest10"](spark, small).orderBy("distance_km", "event_id").first()
    assert (first["event_id"], first["distance_km"]) == (4102, 0.0)
    top = q["grid_hotspots_top5"](spark, small).first()
    assert (top["lat_cell"], top["lng_cell"], top["incidents"]) == (34.16, -118.22, 36)
    days = {(r["state"], str(r["day"]), r["day_incidents"]) for r in q["sigma_anomalies"](spark, small).collect()}
    assert days == {
        ("S14", "2024-01-05", 15),
        ("S16", "2024-01-19", 16),
        ("S31", "2024-01-20", 16),
        ("S33", "2024-01-28", 15),
    }
    route = q["route_ranking_top10"](spark, small).first()
    assert (route["route"], route["incidents"], route["mean_clearance_min"]) == ("I-5", 696, 50.053148)
    metrics = q["ml_metrics"](spark, small).first()
    assert (metrics["accuracy"], metrics["weighted_f1"]) == (0.347936, 0.297282)
    split = {(r["part"], r["label"]): r["n"] for r in q["ml_split_counts"](spark, small).collect()}
    assert [split["train", i] for i in range(4)] == [1535, 1607, 1583, 1584]
    assert [split["test", i] for i in range(4)] == [436, 371, 391, 391]
