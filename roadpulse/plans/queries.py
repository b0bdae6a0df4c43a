"""Registered queries: every operator, run over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.curve import curve_key
from roadpulse.functions.geo import bounding_box
from roadpulse.operators import anomaly, clearance, history, hotspots, nearest, open_incidents, profile, radius, route_ranking, sketch_profile
from roadpulse.operators import severity_model as model
from roadpulse.sources import csv_ingest, layout, shared_dir, tables
from roadpulse.streaming import continuous_ingest

Query = Callable[[SparkSession, str], DataFrame]

# Radius of the selective search, and of influence around a hotspot (km).
NEAR_KM = 5.0
INFLUENCE_KM = 2.0
# Files of the events written as records of several lines.
RECORD_FILES = 4
# Parts in which the history takes the incidents in.
HISTORY_PARTS = 3
# Files of the registered clustered tables.
CLUSTER_FILES = 8
# The state of the one-state hotspot report.
BUSY_STATE = "S7"

_REGISTRY: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Computed doubles to six places, half up.

    Sums of doubles differ in the last digit with the order of rows. Rounding to
    ten places first takes that noise off, so that a value half way between two
    results (a mean of eight) goes the same way in every engine.
    """
    return df.withColumns({n: _six_places(F.col(n)) for n in names})


def _six_places(column: Column) -> Column:
    return F.round(F.round(column, 10), 6)


def _distance_shown(km: Column) -> Column:
    """``_six_places`` of a distance, by way of decimals only near the middle between two results.

    Elsewhere the first rounding does not change the second, and a whole number
    over a million is the double that stands for its decimal.
    """
    millionths = km * 1e6
    whole = F.floor(millionths + 0.5)
    return F.when(F.abs(millionths - F.floor(millionths) - 0.5) > 1e-3, whole / 1e6).otherwise(_six_places(km))


# --- ingest and layout ------------------------------------------------------


def _ingested(spark: SparkSession, sf_dir: str) -> csv_ingest.Ingested:
    return csv_ingest.ingest_lines(
        tables.event_csv_lines(spark, sf_dir), tables.EVENT_CSV_COLUMNS, tables.EVENT_CSV_TYPES
    )


@_query
def ingest_typed(spark, sf_dir):
    return _ingested(spark, sf_dir).clean


@_query
def ingest_rejects(spark, sf_dir):
    return _ingested(spark, sf_dir).rejects


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """The events as CSV files, as such files are: a header in every one of them."""
    path = shared_dir.scratch_path(spark, "events-csv")
    header = ",".join(tables.EVENT_CSV_COLUMNS)
    (
        tables.event_csv_lines(spark, sf_dir)
        .withColumnRenamed("value", header)
        .write.option("header", "true")
        .option("quote", "")
        .option("sep", "\u0001")
        .csv(path)
    )
    return path


def _event_record_files(spark: SparkSession, sf_dir: str) -> str:
    """The same with a line break in every quoted field."""
    path = shared_dir.scratch_path(spark, "event-records")
    lines = tables.event_csv_lines(spark, sf_dir)
    records = lines.select(F.lit(1).alias("at"), F.pmod(F.xxhash64("value"), F.lit(RECORD_FILES)).alias("file"), F.replace("value", F.lit(": "), F.lit(":\n")).alias("value"))
    heads = spark.range(RECORD_FILES).select(F.lit(0).alias("at"), F.col("id").alias("file"), F.lit(",".join(tables.EVENT_CSV_COLUMNS)).alias("value"))
    records.unionByName(heads).repartition("file").sortWithinPartitions("file", "at").drop("at").write.partitionBy("file").text(path)
    return path


@_query
def ingest_csv_files(spark, sf_dir):
    return csv_ingest.ingest_csv(spark, _event_files(spark, sf_dir), tables.EVENT_CSV_TYPES).clean


@_query
def ingest_records(spark, sf_dir):
    return csv_ingest.ingest_csv(spark, _event_record_files(spark, sf_dir), tables.EVENT_CSV_TYPES, multiline=True).clean


@_query
def ingest_record_rejects(spark, sf_dir):
    return csv_ingest.ingest_csv(spark, _event_record_files(spark, sf_dir), tables.EVENT_CSV_TYPES, multiline=True).rejects


def _taken_in(spark: SparkSession, sf_dir: str) -> csv_ingest.Ingested:
    """The same files as they arrive, a few to a micro-batch."""
    out = shared_dir.scratch_path(spark, "taken-in")
    source = _event_record_files(spark, sf_dir)
    for _ in range(2):
        # Started again, it finds nothing new.
        continuous_ingest.follow_csv(spark, source, out, tables.EVENT_CSV_TYPES, files_per_batch=2, multiline=True).awaitTermination()
    return continuous_ingest.taken_in(spark, out)


@_query
def ingest_stream(spark, sf_dir):
    return _taken_in(spark, sf_dir).clean


@_query
def ingest_stream_rejects(spark, sf_dir):
    return _taken_in(spark, sf_dir).rejects


@_query
def ingest_inferred(spark, sf_dir):
    # "oops" among its numbers keeps the undeclared column "value" text.
    return csv_ingest.ingest_csv(spark, _event_files(spark, sf_dir), {}, infer=True).clean


@_query
def convert_roundtrip(spark, sf_dir):
    out = shared_dir.scratch_path(spark, "converted")
    converted = csv_ingest.convert_csv(
        spark, _event_files(spark, sf_dir), out, ("user_id", "event_id"), {"value": "double"}, infer=True, partitions=CLUSTER_FILES
    )
    shared_dir.remove_path(spark, converted.staged)
    return layout.read_clustered(spark, converted.table)


def _clustered(spark: SparkSession, sf_dir: str) -> layout.ClusteredTable:
    path = shared_dir.scratch_path(spark, "clustered")
    return layout.write_clustered(tables.incidents(spark, sf_dir), path, partitions=CLUSTER_FILES, spread_by=["event_id"])


@_query
def clustered_roundtrip(spark, sf_dir):
    return layout.read_clustered(spark, _clustered(spark, sf_dir))


@_query
def layout_zone_map(spark, sf_dir):
    return layout.zone_map(spark, _clustered(spark, sf_dir))


@_query
def layout_zone_totals(spark, sf_dir):
    zones = layout.zone_map(spark, _clustered(spark, sf_dir))
    bounds = [
        aggregate(f"{side}_{key}").alias(f"{side}_{key}")
        for key in layout.CLUSTER_KEYS
        for side, aggregate in (("min", F.min), ("max", F.max))
    ]
    return zones.agg(F.sum("rows").alias("rows"), *bounds)


@_query
def layout_order_check(spark, sf_dir):
    found = layout.order_check(spark, _clustered(spark, sf_dir))
    return found.select("rows", "rows_out_of_order", "files_overlapping", "null_first", (F.col("files") > 1).alias("several_files"))


# Rows of a row group where two layouts are compared.
COMPARED_GROUP = 100


def _along_curve(spark: SparkSession, sf_dir: str, **options) -> layout.ClusteredTable:
    path = shared_dir.scratch_path(spark, "along-curve")
    return layout.write_along_curve(tables.incidents(spark, sf_dir), path, partitions=CLUSTER_FILES, spread_by=["event_id"], **options)


@_query
def curve_roundtrip(spark, sf_dir):
    return layout.read_clustered(spark, _along_curve(spark, sf_dir))


@_query
def curve_keys(spark, sf_dir):
    rows = tables.incidents(spark, sf_dir)
    return rows.select("event_id", curve_key("start_lat", "start_lng").alias("curve_key"))


@_query
def curve_radius_search(spark, sf_dir):
    rows = layout.read_clustered(spark, _along_curve(spark, sf_dir))
    return _rounded(radius.radius_search(rows).select(*_HIT), "distance_km")


@_query
def curve_groups_opened(spark, sf_dir):
    """Row groups that a box of coordinates opens, by state and along the curve."""
    latitudes, longitudes = bounding_box(radius.DEFAULT_LAT, radius.DEFAULT_LNG, NEAR_KM)
    box = {"start_lat": latitudes, "start_lng": longitudes[0]}
    by_state = layout.write_clustered(
        tables.incidents(spark, sf_dir), shared_dir.scratch_path(spark, "by-state"), partitions=CLUSTER_FILES, rows_per_group=COMPARED_GROUP
    )
    found = []
    for name, written in (("state", by_state), ("curve", _along_curve(spark, sf_dir, rows_per_group=COMPARED_GROUP))):
        zones = layout.row_group_zones(spark, written, list(box), COMPARED_GROUP)
        inside = layout.read_clustered(spark, written).filter(
            F.col("start_lat").between(*box["start_lat"]) & F.col("start_lng").between(*box["start_lng"])
        )
        opened = layout.opened_by_box(zones, box).withColumn("rows_in_box", F.lit(0).cast("long"))
        counted = inside.agg(F.count("*").alias("rows_in_box"))
        found.append(opened.unionByName(counted, allowMissingColumns=True).withColumn("layout", F.lit(name)))
    sides = found[0].unionByName(found[1])

    def of(name, column):
        return F.max(F.when(F.col("layout") == name, F.col(column)))

    return sides.agg(
        of("state", "rows").alias("rows"),
        of("state", "rows_in_box").alias("state_rows_in_box"),
        of("curve", "rows_in_box").alias("curve_rows_in_box"),
        (of("curve", "rows_opened") >= of("curve", "rows_in_box")).alias("box_is_covered"),
        (2 * of("curve", "groups_opened") <= of("state", "groups_opened")).alias("half_or_fewer_opened"),
    )


# --- first look -------------------------------------------------------------


@_query
def sample_head(spark, sf_dir):
    rows = profile.sample_head(tables.incidents(spark, sf_dir), order="event_id")
    return rows.select("event_id", "severity", "state", "street", "start_time", "sunrise_sunset")


@_query
def column_profile(spark, sf_dir):
    return profile.column_profile(tables.incidents(spark, sf_dir))


@_query
def sketch_profile_bounds(spark, sf_dir):
    """Sketches per state, merged, against exact values."""
    rows = tables.incidents(spark, sf_dir)
    kept = shared_dir.written(sketch_profile.column_sketches(rows, by=["state"]), "column-sketches")
    return sketch_profile.against_exact(rows, sketch_profile.estimates(sketch_profile.merged(kept)))


@_query
def sketch_profile_values(spark, sf_dir):
    """Columns with fewer values than the sketches follow: exact, whatever they were merged from."""
    rows = tables.incidents(spark, sf_dir)
    kept = shared_dir.written(sketch_profile.column_sketches(rows, by=["state"], columns=["severity", "sunrise_sunset", "street"]), "column-sketches")
    found = sketch_profile.estimates(sketch_profile.merged(kept), most=sketch_profile.FOLLOWED)
    return found.select("column_name", F.inline("frequent")).select("column_name", F.col("item").alias("value"), F.col("count").alias("n"))


# --- radius search ----------------------------------------------------------

_HIT = ("event_id", "start_lat", "start_lng", "severity", "distance_km")


def _hits(spark: SparkSession, sf_dir: str, **kwargs) -> DataFrame:
    return radius.radius_search(tables.incidents(spark, sf_dir), **kwargs)


@_query
def radius_search(spark, sf_dir):
    return _rounded(_hits(spark, sf_dir).select(*_HIT), "distance_km")


@_query
def radius_search_near(spark, sf_dir):
    return _rounded(_hits(spark, sf_dir, radius_km=NEAR_KM).select(*_HIT), "distance_km")


@_query
def radius_nearest10(spark, sf_dir):
    return _rounded(radius.nearest(_hits(spark, sf_dir).select(*_HIT), tie_break="event_id"), "distance_km")


@_query
def radius_count(spark, sf_dir):
    return radius.hit_count(_hits(spark, sf_dir))


# --- nearest without a radius, many centres ---------------------------------

# In the middle of the incidents, across an ocean, at a pole, on the seam of longitudes.
PLACES = {"near": (34.05, -118.24), "far": (51.5, -0.13), "pole": (90.0, 0.0), "seam": (-10.0, 180.0)}
# Around each depot: the radius in which incidents are listed, and that in which they are counted.
LISTED_KM, COUNTED_KM = 2.0, 10.0


@_query
def nearest_anywhere(spark, sf_dir):
    rows = tables.incidents(spark, sf_dir).select("event_id", "start_lat", "start_lng")
    found = [
        nearest.nearest_anywhere(rows, *at, tie_break="event_id").select(F.lit(name).alias("place"), "event_id", "distance_km")
        for name, at in PLACES.items()
    ]
    return _rounded(functools.reduce(DataFrame.unionByName, found), "distance_km")


@_query
def incidents_around_depots(spark, sf_dir):
    return nearest.rows_around(tables.incidents(spark, sf_dir), tables.depots(spark, sf_dir), LISTED_KM, "depot", "event_id", shown=_distance_shown)


@_query
def incident_counts_around_depots(spark, sf_dir):
    return nearest.counts_around(tables.incidents(spark, sf_dir), tables.depots(spark, sf_dir), COUNTED_KM, "depot")


# --- hotspots ---------------------------------------------------------------


@_query
def grid_cell_counts(spark, sf_dir):
    return hotspots.grid_cells(tables.incidents(spark, sf_dir), where=hotspots.severe())


@_query
def grid_hotspots_top5(spark, sf_dir):
    return hotspots.grid_hotspots(tables.incidents(spark, sf_dir))


@_query
def hotspots_density(spark, sf_dir):
    return hotspots.top_cells(hotspots.grid_cells(tables.incidents(spark, sf_dir)))


@_query
def hotspots_weighted(spark, sf_dir):
    cells = hotspots.grid_cells(tables.incidents(spark, sf_dir), weight="severity")
    return hotspots.top_cells(cells, by="danger")


@_query
def hotspots_one_state(spark, sf_dir):
    in_state = hotspots.severe() & (F.col("state") == BUSY_STATE)
    return hotspots.grid_hotspots(tables.incidents(spark, sf_dir), where=in_state)


def _influence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.cells_within_radius(
        tables.incidents(spark, sf_dir), INFLUENCE_KM, where=hotspots.severe()
    )


@_query
def hotspots_radius_cells(spark, sf_dir):
    return _influence(spark, sf_dir)


@_query
def hotspots_radius(spark, sf_dir):
    return hotspots.top_cells(_influence(spark, sf_dir))


# --- routes -----------------------------------------------------------------


@_query
def route_normalised(spark, sf_dir):
    return route_ranking.street_routes(tables.incidents(spark, sf_dir))


@_query
def route_normalised_anchored(spark, sf_dir):
    return route_ranking.street_routes(tables.incidents(spark, sf_dir), anchored=True)


@_query
def route_ranking_top10(spark, sf_dir):
    totals = route_ranking.route_totals(tables.incidents(spark, sf_dir))
    return _rounded(route_ranking.route_ranking(totals), "mean_clearance_min")


@_query
def highway_ranking_top10(spark, sf_dir):
    totals = route_ranking.route_totals(tables.incidents(spark, sf_dir), highways_only=True)
    return _rounded(route_ranking.route_ranking(totals), "mean_clearance_min")


# --- anomalous days ---------------------------------------------------------

_HISTORY = ("hist_mean", "hist_std", "threshold")


@_query
def daily_rollup(spark, sf_dir):
    return _rounded(anomaly.daily_rollup(tables.incidents(spark, sf_dir)), *anomaly.WEATHER)


@_query
def daily_rollup_prefix(spark, sf_dir):
    daily = anomaly.daily_rollup(tables.incidents(spark, sf_dir), day_from="prefix")
    return _rounded(daily, *anomaly.WEATHER)


@_query
def entity_history_stats(spark, sf_dir):
    history = anomaly.entity_history(anomaly.daily_rollup(tables.incidents(spark, sf_dir)))
    return _rounded(history, "hist_mean", "hist_std")


def _anomalies(spark: SparkSession, sf_dir: str, **rollup) -> DataFrame:
    return anomaly.sigma_anomalies(anomaly.daily_rollup(tables.incidents(spark, sf_dir), **rollup))


def _anomalies_by_join(spark: SparkSession, sf_dir: str, **rollup) -> DataFrame:
    daily = anomaly.daily_rollup(tables.incidents(spark, sf_dir), **rollup)
    return anomaly.sigma_anomalies(shared_dir.written(daily, "daily-rollup"), form="join")


@_query
def sigma_anomalies(spark, sf_dir):
    return _rounded(_anomalies(spark, sf_dir), *_HISTORY, *anomaly.WEATHER)


@_query
def sigma_anomalies_join(spark, sf_dir):
    return _rounded(_anomalies_by_join(spark, sf_dir), *_HISTORY, *anomaly.WEATHER)


@_query
def sigma_anomalies_prefix(spark, sf_dir):
    # By join: malformed times make "days" without the bound of a calendar.
    found = _anomalies_by_join(spark, sf_dir, day_from="prefix")
    return _rounded(found, *_HISTORY, *anomaly.WEATHER)


@_query
def sigma_anomalies_weather(spark, sf_dir):
    found = _anomalies(spark, sf_dir, means=anomaly.WEATHER_WITH_WIND)
    return _rounded(found, *_HISTORY, *anomaly.WEATHER_WITH_WIND)


@_query
def sigma_anomalies_top5(spark, sf_dir):
    return _rounded(anomaly.top_days(_anomalies(spark, sf_dir)), *_HISTORY, *anomaly.WEATHER)


@_query
def sigma_anomalies_count(spark, sf_dir):
    return anomaly.anomaly_count(_anomalies(spark, sf_dir))


def _history(spark: SparkSession, sf_dir: str) -> history.History:
    """All incidents, taken in by parts that share their days."""
    kept = history.History(spark, shared_dir.scratch_path(spark, "history"))
    rows = tables.incidents(spark, sf_dir)
    for part in range(HISTORY_PARTS):
        kept.absorb(rows.filter(F.pmod("event_id", F.lit(HISTORY_PARTS)) == part))
        if part == 1:
            kept.compact()
    return kept


@_query
def history_moments(spark, sf_dir):
    found = _history(spark, sf_dir).moments()
    std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return _rounded(found.select("state", F.col("mean").alias("hist_mean"), std.alias("hist_std"), F.col("n").alias("observed_days")), "hist_mean", "hist_std")


@_query
def history_anomalies(spark, sf_dir):
    return _rounded(_history(spark, sf_dir).anomalies(), *_HISTORY, *anomaly.WEATHER)


def _order_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.sigma_anomalies(tables.daily_orders(spark, sf_dir), "nation", "day_orders")


@_query
def order_spike_top5(spark, sf_dir):
    # Far more days than five, and many with as many orders.
    return _rounded(anomaly.top_days(_order_spikes(spark, sf_dir), entity="nation", metric="day_orders"), *_HISTORY)


@_query
def daily_by_prefix_of_text(spark, sf_dir):
    # Times that do not parse make days of their own by prefix, and none when parsed.
    daily = anomaly.daily_rollup(tables.incidents(spark, sf_dir), day_from="prefix")
    return daily.groupBy("day").agg(F.sum("day_incidents").alias("incidents"))


@_query
def order_spike_days(spark, sf_dir):
    return _rounded(_order_spikes(spark, sf_dir), *_HISTORY)


# --- clearance --------------------------------------------------------------


@_query
def clearance_by_light_daytype(spark, sf_dir):
    return _rounded(clearance.clearance_by(tables.incidents(spark, sf_dir)), "mean_clearance_min")


@_query
def clearance_unparsed_as_weekday(spark, sf_dir):
    rows = clearance.clearance_by(tables.incidents(spark, sf_dir), unknown="weekday")
    return _rounded(rows, "mean_clearance_min")


@_query
def clearance_by_twilight(spark, sf_dir):
    lights = ("sunrise_sunset", "astronomical_twilight")
    return _rounded(clearance.clearance_by(tables.incidents(spark, sf_dir), lights), "mean_clearance_min")


# --- incidents open at once -------------------------------------------------


@_query
def open_by_hour(spark, sf_dir):
    return _rounded(open_incidents.open_by_hour(tables.incidents(spark, sf_dir)), "open_minutes")


@_query
def open_by_state(spark, sf_dir):
    return open_incidents.open_at(tables.incidents(spark, sf_dir), by="state")


@_query
def open_unusable(spark, sf_dir):
    return open_incidents.unusable(tables.incidents(spark, sf_dir))


# --- severity model ---------------------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.feature_frame(tables.incidents(spark, sf_dir))


@_query
def ml_feature_rows(spark, sf_dir):
    return _features(spark, sf_dir)


@_query
def ml_label_counts(spark, sf_dir):
    return model.label_counts(_features(spark, sf_dir))


@_query
def ml_category_index(spark, sf_dir):
    return model.category_index(_features(spark, sf_dir))


@_query
def ml_split_counts(spark, sf_dir):
    return model.split_counts(_features(spark, sf_dir))


@_query
def ml_split_counts_null_keys(spark, sf_dir):
    key = F.expr("CASE WHEN event_id % 7 <> 0 THEN event_id END")
    rows = _features(spark, sf_dir).withColumn("key", key)
    train, test = model.split(rows, "key")
    counts = model.split_counts(rows, "key")
    split = train.select(F.lit("train rows").alias("part"), "label").unionAll(test.select(F.lit("test rows").alias("part"), "label"))
    return counts.unionByName(split.groupBy("part", "label").agg(F.count("*").alias("n")))


@_query
def ml_test_rows(spark, sf_dir):
    _, test = model.split(_features(spark, sf_dir))
    return test.select("event_id", "severity", "label")


def _rule_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.confusion(model.threshold_prediction(_features(spark, sf_dir)))


@_query
def ml_confusion(spark, sf_dir):
    return _rule_confusion(spark, sf_dir)


@_query
def ml_metrics(spark, sf_dir):
    return _rounded(model.quality(_rule_confusion(spark, sf_dir)), "accuracy", "weighted_f1")


@_query
def ml_assembled_rows(spark, sf_dir):
    rows = model.assembled_rows(_features(spark, sf_dir))
    return _rounded_list(rows, "features")


@_query
def ml_tree_checks(spark, sf_dir):
    features = _features(spark, sf_dir)
    return model.tree_checks(features, model.train_and_predict(features))


def _rounded_list(df: DataFrame, name: str) -> DataFrame:
    """An array of doubles as text of six places each."""
    places = F.transform(name, lambda x: F.format_string("%.6f", F.round(F.round(x, 10), 6)))
    return df.withColumn(name, F.array_join(places, " "))


def _tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.train_and_predict(_features(spark, sf_dir)).predictions


@_query
def ml_train_predict(spark, sf_dir):
    return _tree_predictions(spark, sf_dir).select("event_id", "severity", "label", "prediction")


@_query
def ml_tree_metrics(spark, sf_dir):
    return model.quality(model.confusion(_tree_predictions(spark, sf_dir)))


@_query
def ml_prediction_sample(spark, sf_dir):
    sample = model.prediction_sample(_tree_predictions(spark, sf_dir))
    return sample.withColumn("features", F.to_json(vector_to_array("features")))
