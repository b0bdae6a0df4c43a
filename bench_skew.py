"""Times the jobs on a larger, skewed table; prints one line per job.

    python bench_skew.py <scratch folder> [copies]

The table is made by Spark from the sf0.1 events, ``copies`` (default 100) times
over: a third of its rows share one coordinate, street and state, the others
spread over the country. Beside the time stand the rows and bytes shuffled and
the largest number of rows any task read from a shuffle, all from the event log.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadpulse.functions.geo import great_circle_km
from roadpulse.functions.routes import normalise_route
from roadpulse.functions.timecols import elapsed_seconds, parse_time
from roadpulse.operators import anomaly, clearance, hotspots, profile, radius, route_ranking
from roadpulse.operators import severity_model as model
from roadpulse.sources import layout, tables

SOURCE = "/root/testdata/sf0.1"


def session(scratch: str) -> SparkSession:
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs, exist_ok=True)
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.driver.memory", "16g")
        .config("spark.log.level", "ERROR")
        .config("spark.checkpoint.dir", os.path.join(scratch, "shared"))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{logs}")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )


def make_table(spark: SparkSession, scratch: str, copies: int) -> DataFrame:
    path = os.path.join(scratch, f"incidents-{copies}")
    if not os.path.exists(path):
        rows = spark.read.parquet(f"{SOURCE}/events.parquet").count()
        events = tables.table(spark, SOURCE, "events").repartition(32)
        copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        big = os.path.join(scratch, f"source-{copies}")
        (
            events.withColumn("copy", copy)
            .withColumn("event_id", F.col("event_id") + F.col("copy") * rows)
            .withColumn("ts", F.timestamp_add("DAY", F.col("copy") * 30, F.col("ts")))
            .drop("copy")
            .write.parquet(f"{big}/events.parquet")
        )

        def uniform(salt: int):
            return F.pmod(F.xxhash64("event_id", F.lit(salt)), F.lit(10**6)) / 1e6

        hot = F.col("event_id") % 3 == 0
        (
            tables.incidents(spark, big)
            .withColumn("start_lat", F.when(hot, 34.05).otherwise(F.round(25 + uniform(1) * 24, 6)))
            .withColumn("start_lng", F.when(hot, -118.24).otherwise(F.round(-124 + uniform(2) * 57, 6)))
            .withColumn("state", F.when(hot, "S7").otherwise(F.col("state")))
            .withColumn(
                "street",
                F.when(hot, "I-10 W").otherwise(
                    F.concat(F.lit("Road "), F.pmod(F.xxhash64("event_id"), F.lit(200_000)))
                ),
            )
            .write.parquet(path)
        )
    return spark.read.parquet(path)


def jobs(inc: DataFrame, clustered: DataFrame) -> dict:
    def plain_routes():
        seconds = elapsed_seconds(parse_time("start_time"), parse_time("end_time"))
        return (
            inc.filter(hotspots.severe())
            .select(normalise_route("street").alias("route"), seconds.alias("seconds"))
            .groupBy("route")
            .agg(F.count("*").alias("incidents"), F.avg("seconds"))
        )

    def plain_radius(df):
        return df.filter(great_circle_km("start_lat", "start_lng", 40.0, -100.0) <= 25.0).agg(F.count("*"))

    def boxed_radius(df):
        return radius.hit_count(radius.radius_search(df, lat0=40.0, lng0=-100.0))

    daily = anomaly.daily_rollup(inc)
    return {
        "scan": lambda: inc,
        "radius count": lambda: boxed_radius(inc),
        "radius count, no box": lambda: plain_radius(inc),
        "radius count, by place": lambda: boxed_radius(clustered),
        "radius count, by place, no box": lambda: plain_radius(clustered),
        "nearest 10": lambda: radius.nearest(radius.radius_search(inc), tie_break="event_id"),
        "grid hotspots": lambda: hotspots.grid_hotspots(inc),
        "radius hotspots": lambda: hotspots.top_cells(hotspots.cells_within_radius(inc, where=hotspots.severe())),
        "routes": lambda: route_ranking.route_totals(inc),
        "routes, names per row": plain_routes,
        "anomalies, window": lambda: anomaly.sigma_anomalies(daily),
        "anomalies, join unwritten": lambda: anomaly.sigma_anomalies(daily, form="join"),
        "clearance": lambda: clearance.clearance_by(inc),
        "column profile": lambda: profile.column_profile(inc),
        "split counts": lambda: model.split_counts(model.feature_frame(inc)),
    }


def shuffle_figures(logs: str) -> dict[str, tuple[int, int, int]]:
    """Per job name: rows and bytes written to shuffles, most rows read by a task."""
    stage_job: dict[int, str] = {}
    rows, size, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in glob.glob(f"{logs}/*"):
        with open(path) as lines:
            for event in map(json.loads, lines):
                if event["Event"] == "SparkListenerStageSubmitted":
                    name = (event.get("Properties") or {}).get("spark.job.description")
                    if name:
                        stage_job[event["Stage Info"]["Stage ID"]] = name
                elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in stage_job:
                    name, metrics = stage_job[event["Stage ID"]], event.get("Task Metrics") or {}
                    written = metrics.get("Shuffle Write Metrics", {})
                    rows[name] += written.get("Shuffle Records Written", 0)
                    size[name] += written.get("Shuffle Bytes Written", 0)
                    read = metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    most[name] = max(most[name], read)
    return {name: (rows[name], size[name], most[name]) for name in set(stage_job.values())}


def main() -> None:
    scratch = sys.argv[1]
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 100
    spark = session(scratch)
    inc = make_table(spark, scratch, copies)
    placed = os.path.join(scratch, f"clustered-{copies}")
    seconds = {}
    if not os.path.exists(placed):
        spark.sparkContext.setJobDescription("cluster")
        start = time.perf_counter()
        layout.cluster_parquet(
            spark,
            os.path.join(scratch, f"incidents-{copies}"),
            placed,
            keys=("start_lat", "start_lng"),
            rows_per_file=500_000,
        )
        seconds["cluster"] = time.perf_counter() - start
    for name, job in jobs(inc, spark.read.parquet(placed)).items():
        for attempt in range(4):
            # Only the last run is looked up in the log; the first two warm up.
            spark.sparkContext.setJobDescription(name if attempt == 3 else None)
            start = time.perf_counter()
            job().write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
            if attempt >= 2:
                seconds[name] = min(seconds.get(name, taken), taken)
    spark.stop()
    figures = shuffle_figures(os.path.join(scratch, "eventlog"))
    print("| job | seconds | rows shuffled | MB shuffled | most rows in a task |")
    print("| --- | --- | --- | --- | --- |")
    for name, taken in seconds.items():
        rows, size, most = figures.get(name, (0, 0, 0))
        print(f"| {name} | {taken:.2f} | {rows:,} | {size / 1e6:.1f} | {most:,} |")


if __name__ == "__main__":
    main()
