"""The physical plans are the ones meant."""

import pytest

from roadpulse.operators import anomaly, hotspots, radius, route_ranking
from roadpulse.operators import severity_model as model
from roadpulse.plans import queries
from roadpulse.sources import layout, tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """Incidents as a real table, where coordinates are plain columns."""
    path = str(tmp_path_factory.mktemp("stored") / "t")
    table = layout.write_clustered(tables.incidents(spark, small), path, partitions=2)
    return tables.read_incidents(spark, table.path)


def test_radius_box_reaches_the_scan(stored):
    df = radius.radius_search(stored, radius_km=5.0).select("event_id", "distance_km")
    plan = _plan(df)
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    for bound in ("GreaterThanOrEqual(start_lat", "LessThanOrEqual(start_lat", "GreaterThanOrEqual(start_lng"):
        assert bound in pushed
    assert "ReadSchema: struct<event_id:bigint,start_lat:double,start_lng:double>" in plan
    assert "Exchange" not in plan


def test_top_k_without_full_sort(stored):
    for df in (
        radius.nearest(radius.radius_search(stored), tie_break="event_id"),
        hotspots.grid_hotspots(stored),
        route_ranking.route_ranking(route_ranking.route_totals(stored)),
        anomaly.top_days(anomaly.sigma_anomalies(anomaly.daily_rollup(stored))),
    ):
        plan = _plan(df)
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan


def test_severity_reaches_the_scan(stored):
    assert "GreaterThanOrEqual(severity,3)" in _plan(hotspots.grid_hotspots(stored))


def test_aggregations_start_on_the_map_side(stored):
    for df in (
        hotspots.grid_cells(stored),
        route_ranking.route_totals(stored),
        anomaly.daily_rollup(stored),
        hotspots.cells_within_radius(stored),
    ):
        plan = _plan(df)
        assert "partial_count(" in plan
        assert "Python" not in plan


def test_one_window_operator(stored):
    plan = _plan(anomaly.sigma_anomalies(anomaly.daily_rollup(stored)))
    assert plan.count("Window [") == 1
    assert plan.count("FileScan") == 1


def test_join_form_reads_the_source_once(spark, small):
    df = queries.sigma_anomalies_join(spark, small)
    assert "events" not in _plan(df)


def test_no_cross_joins_or_python(spark, tiny):
    for name, query in queries.registered().items():
        if name in ("ml_train_predict", "ml_tree_metrics", "ml_prediction_sample", "ml_tree_checks"):
            continue  # scoring is MLlib's own function
        plan = _plan(query(spark, tiny))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "PythonUDF" not in plan and "MapInPandas" not in plan, name


def test_training_leaves_nothing_cached(spark, tiny):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    model.train_and_predict(model.feature_frame(tables.incidents(spark, tiny)))
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_category_index_scans_once(stored):
    plan = _plan(model.category_index(model.feature_frame(stored)))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2


def test_daily_orders_counts_after_the_join(spark, small):
    plan = _plan(tables.daily_orders(spark, small))
    assert plan.count("partial_count") == 1
