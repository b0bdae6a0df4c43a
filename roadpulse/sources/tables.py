"""The incident table: a real one, or the one projected from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.sources.csv_ingest import snake_case


# Declared, so that reading starts no job to look into file footers.
_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def read_incidents(spark: SparkSession, path: str) -> DataFrame:
    """An incident Parquet table under any spelling of its columns, as snake case."""
    df = spark.read.parquet(path)
    return df.withColumnsRenamed({c: snake_case(c) for c in df.columns})


# The cast of a timestamp does not look at the session's time zone, unlike
# date_format. It drops trailing zeros and the point; _full_text puts them back.
_TIME_TEXTS = (
    "CAST(ts AS STRING) AS start_text",
    "CAST(timestampadd(MICROSECOND, CAST(floor(value * 60000000 + 0.5) AS BIGINT), ts) AS STRING) AS end_text",
)


def _full_text(text: str) -> str:
    return f"rpad(if(length({text}) = 19, {text} || '.', {text}), 26, '0')"


_INCIDENT_COLUMNS = (
    "event_id",
    "1 + event_id % 4 AS severity",
    """CASE WHEN event_id % 97 <> 0 THEN CAST(33.9 AS DOUBLE) + CAST(user_id * 13 % 30 AS DOUBLE) / 100
         + CAST(event_id % 7 AS DOUBLE) / 1000 END AS start_lat""",
    """CASE WHEN event_id % 89 <> 0 THEN CAST(-118.4 AS DOUBLE) + CAST(user_id * 29 % 40 AS DOUBLE) / 100
         + CAST(event_id % 11 AS DOUBLE) / 1000 END AS start_lng""",
    f"""CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'bad-time'
         ELSE {_full_text("start_text")} END AS start_time""",
    f"{_full_text("end_text")} AS end_time",
    """CASE WHEN event_id % 53 = 0 THEN NULL WHEN hour(ts) BETWEEN 6 AND 17 THEN 'Day'
         ELSE 'Night' END AS sunrise_sunset""",
    """CASE WHEN event_id % 59 = 0 THEN NULL WHEN hour(ts) BETWEEN 5 AND 18 THEN 'Day'
         ELSE 'Night' END AS astronomical_twilight""",
    "CASE WHEN event_id % 61 <> 0 THEN 'S' || (user_id % 50) END AS state",
    """CASE event_id % 9
         WHEN 1 THEN 'I- ' || (5 + user_id % 12)
         WHEN 2 THEN 'I-' || (5 + user_id % 12) || ' N'
         WHEN 3 THEN 'us ' || (101 + user_id % 5)
         WHEN 4 THEN 'Hawaii 5 Hwy'
         WHEN 5 THEN 'Main St'
         WHEN 6 THEN 'MAIN ST'
         WHEN 7 THEN 'US - ' || (101 + user_id % 5)
         WHEN 8 THEN 'i ' || (5 + user_id % 12) END AS street""",
    "CASE WHEN event_id % 10 <> 0 THEN value / 100 END AS precipitation_in",
    "CASE WHEN event_id % 13 <> 0 THEN 10 - value / 50 END AS visibility_mi",
    "CASE WHEN event_id % 17 <> 0 THEN value / 10 END AS wind_speed_mph",
    """CASE WHEN event_id % 19 <> 0
         THEN 40 + 15 * CAST(event_id % 4 AS DOUBLE) + value / 20 END AS temperature_f""",
    "CASE WHEN event_id % 23 <> 0 THEN CAST(20 + user_id % 80 AS DOUBLE) END AS humidity_pct",
)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per event: same rows, columns computed from event and user.

    A narrow projection of the whole table. Nulls and bad times are put in by
    key, as the source has none.
    """
    return table(spark, sf_dir, "events").selectExpr("*", *_TIME_TEXTS).selectExpr(*_INCIDENT_COLUMNS)


def depots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place per supplier, most of them where the incidents are; some have none."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS depot",
        "CASE WHEN s_suppkey % 23 <> 0 THEN CAST(33.8 AS DOUBLE) + CAST(s_suppkey * 7 % 50 AS DOUBLE) / 100 END AS lat0",
        "CAST(-118.5 AS DOUBLE) + CAST(s_suppkey * 11 % 60 AS DOUBLE) / 100 AS lng0",
    )


_CSV_HEAD = "event_id || ',' || user_id || ',' || event_type"
_CSV_NUMBER = """CASE WHEN event_id % 103 = 0 THEN 'oops' WHEN event_id % 109 = 0 THEN 'N/A'
                      ELSE CAST(value AS STRING) END"""
_CSV_QUOTED = """'"' || replace(props, '"', '""') || '"'"""


def event_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV line per event in column ``value``, some broken by key.

    Broken: two fields missing, one field too many, or a number that is none.
    Some numbers are a null token, and the last field holds quotes.
    """
    return table(spark, sf_dir, "events").selectExpr(
        f"""{_CSV_HEAD} || CASE
              WHEN event_id % 101 = 0 THEN ''
              WHEN event_id % 107 = 0 THEN ',' || {_CSV_NUMBER} || ',' || {_CSV_QUOTED} || ',surplus'
              ELSE ',' || {_CSV_NUMBER} || ',' || {_CSV_QUOTED} END AS value"""
    )


EVENT_CSV_COLUMNS = ("event_id", "user_id", "event_type", "value", "props")
EVENT_CSV_TYPES = {"event_id": "bigint", "user_id": "bigint", "value": "double"}


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per nation and day, as the rollup of a second kind of record.

    Orders are joined first and counted per nation and day on the map side:
    hardly any customer orders twice a day, so counting per customer before the
    join would shuffle nearly every order once more.
    """
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("day"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
        .groupBy("c_nationkey", "day")
        .agg(F.count("*").alias("day_orders"))
        .join(nations, "c_nationkey")
        .select(F.col("n_name").alias("nation"), "day", "day_orders")
    )
