"""How many incidents are open at once, by a sweep over their beginnings and ends.

An incident is open from its start to before its end. Beginnings count one up and
ends one down; the running sum over time is the number open. Changes of one moment
are summed first, then range-partitioned by time: each partition adds up its own
changes and starts from the sum of all partitions before it, so time is swept in
many tasks and only their totals pass from one to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.timecols import parse_time
from roadpulse.sources.shared_dir import written


def changes(df: DataFrame, start: str = "start_time", end: str = "end_time", by: str | None = None) -> DataFrame:
    """(``by``, ``moment``, ``change``, ``began``): what begins less what ends at each moment.

    Incidents whose start does not parse, or whose end does not or lies before the
    start, are left out (``unusable`` counts them); one that ends as it starts is
    never open, but it began.
    """
    rows = _timed(df, start, end, by).filter("usable")
    ends = F.array(
        F.struct(F.col("s").alias("moment"), F.lit(1).alias("change"), F.lit(1).alias("began")),
        F.struct(F.col("e").alias("moment"), F.lit(-1).alias("change"), F.lit(0).alias("began")),
    )
    keys = ["by"] if by else []
    return (
        rows.select(*keys, F.inline(ends))
        .groupBy(*keys, "moment")
        .agg(F.sum("change").alias("change"), F.sum("began").alias("began"))
    )


def _timed(df: DataFrame, start: str, end: str, by: str | None) -> DataFrame:
    times = [parse_time(start).alias("s"), parse_time(end).alias("e")]
    rows = df.select(*([F.col(by).alias("by")] if by else []), *times)
    return rows.withColumn("usable", F.coalesce(F.col("e") >= F.col("s"), F.lit(False)))


def unusable(df: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Number of incidents whose times do not bound them, as a one-row frame."""
    return _timed(df, start, end, None).agg(F.count_if(~F.col("usable")).alias("unusable"))


def open_at(df: DataFrame, start: str = "start_time", end: str = "end_time", by: str | None = None, partitions: int | None = None) -> DataFrame:
    """(``by``, ``moment``, ``open``): how many are open from each moment on until the next (two actions, then lazy).

    With ``by``, per value of that column, nulls a value of their own. However
    many moments a value has, they are swept by range: a value with a third of
    all incidents is spread over many tasks like any other stretch of the sweep.
    """
    keys = ["by"] if by else []
    moments = written(changes(df, start, end, by).drop("began"), "changes")
    return _swept(moments, keys, partitions).select(*([F.col("by").alias(by)] if by else []), "moment", "open")


def _swept(moments: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    """``moments`` with the running sum of ``change`` in ``open``, in the order of ``keys`` and ``moment``."""
    number = partitions or max(1, int(moments.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [*keys, "moment"]
    placed = moments.repartitionByRange(number, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    placed = written(placed, "swept")
    # The carry: a row per partition and value, as a partition holds a run of values.
    totals = placed.groupBy("part", *keys).agg(F.sum("change").alias("total"))
    of_value = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("part", *keys, F.coalesce(F.sum("total").over(of_value), F.lit(0)).alias("carry"))
    within = Window.partitionBy("part", *keys).orderBy("moment")
    running = placed.withColumn("own", F.sum("change").over(within))
    same = F.col("c.part") == F.col("r.part")
    for k in keys:
        same = same & F.col(f"c.{k}").eqNullSafe(F.col(f"r.{k}"))
    joined = running.alias("r").join(carry.alias("c"), same)
    return joined.select(*[f"r.{k}" for k in keys], "r.moment", "r.change", (F.col("own") + F.col("carry")).alias("open"))


def open_by_hour(df: DataFrame, start: str = "start_time", end: str = "end_time", partitions: int | None = None) -> DataFrame:
    """Per hour of the calendar, from the first to the last with an incident open or begun (several actions, then lazy).

    ``began`` in it, ``open_before``, those open when it begins, ``most_open`` at any
    moment of it, and ``open_minutes``, the time for which each was open in it, summed.
    Hours in which nothing changes have a row too.
    """
    moments = written(changes(df, start, end), "changes")
    # The full hours between the first and the last moment, as moments without a change, bound every stretch.
    span = moments.agg(F.min("moment").alias("a"), F.max("moment").alias("b")).filter("a IS NOT NULL")
    hours = span.select(F.explode(F.sequence(_hour("a"), _hour("b"), F.expr("INTERVAL 1 HOUR"))).alias("moment"))
    marks = hours.select("moment", F.lit(0).cast("long").alias("change"), F.lit(0).cast("long").alias("began"), F.lit(True).alias("mark"))
    every = moments.withColumn("mark", F.lit(False)).unionByName(marks)
    every = every.groupBy("moment").agg(F.sum("change").alias("change"), F.sum("began").alias("began"), F.max("mark").alias("mark"))
    every = written(every, "changes-and-hours")
    swept = _swept(every, [], partitions).join(every.select("moment", "began", "mark"), "moment")
    hour = _hour("moment").alias("hour")
    # Every stretch ends at the next moment of its hour, or with the hour.
    in_hour = Window.partitionBy("hour").orderBy("moment")
    stretch = swept.withColumn("hour", hour).withColumn(
        "until", F.coalesce(F.lead("moment").over(in_hour), F.col("hour") + F.expr("INTERVAL 1 HOUR"))
    )
    micros = F.timestamp_diff("MICROSECOND", F.col("moment"), F.col("until"))
    return stretch.groupBy("hour").agg(
        F.sum("began").alias("began"),
        F.max(F.when(F.col("mark"), F.col("open") - F.col("change"))).alias("open_before"),
        F.max("open").alias("most_open"),
        (F.sum(F.col("open") * micros) / F.lit(60e6)).alias("open_minutes"),
    )


def _hour(column: str) -> Column:
    return F.date_trunc("hour", F.col(column)).cast("timestamp_ntz")

