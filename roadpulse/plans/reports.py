"""The standard reports over one incident table, with their usual settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from roadpulse.operators import anomaly, clearance, hotspots, profile, radius, route_ranking
from roadpulse.operators import severity_model as model


def _hits(df: DataFrame) -> DataFrame:
    return radius.radius_search(df).select("start_lat", "start_lng", "severity", "distance_km")


def _anomalies(df: DataFrame) -> DataFrame:
    return anomaly.sigma_anomalies(anomaly.daily_rollup(df, means=anomaly.WEATHER_WITH_WIND))


def _model_quality(df: DataFrame, key: str = "id") -> DataFrame:
    trained = model.train_and_predict(model.feature_frame(df, keep=[key]), key=key)
    return model.quality(model.confusion(trained.predictions))


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "sample": profile.sample_head,
    "columns": profile.column_profile,
    "nearest": lambda df: radius.nearest(_hits(df)),
    "in-radius": lambda df: radius.hit_count(_hits(df)),
    "hotspots": hotspots.grid_hotspots,
    "hotspots-radius": lambda df: hotspots.top_cells(
        hotspots.cells_within_radius(df, where=hotspots.severe())
    ),
    "routes": lambda df: route_ranking.route_ranking(route_ranking.route_totals(df)),
    "highways": lambda df: route_ranking.route_ranking(route_ranking.route_totals(df, highways_only=True)),
    "anomalies": lambda df: anomaly.top_days(_anomalies(df)),
    "anomaly-count": lambda df: anomaly.anomaly_count(_anomalies(df)),
    "clearance": clearance.clearance_by,
    "model": _model_quality,
}
