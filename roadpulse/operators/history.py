"""An entity's history that takes in new rows without reading the old ones again.

Kept are sums per entity and day, and per entity the moments of its days: how many,
their mean, and the sum of squared deviations. Moments of separate sets of days
merge by Chan's rule, and come apart by it again. New rows change the days they
fall on: those days' old values are taken out of the moments and their new ones
put in. Only these days are looked up.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.timecols import parse_time
from roadpulse.operators.anomaly import SIGMAS, WEATHER
from roadpulse.sources.shared_dir import children, path_exists, remove_path

_DAYS, _MOMENTS = "days", "moments"


def day_sums(df: DataFrame, entity: str = "state", time: str = "start_time", means: Mapping[str, str] = WEATHER) -> DataFrame:
    """Per entity and day: rows, and per measure its sum and number of values. Such sums add up over parts of the rows.

    Rows without an entity or a time that parses are in no day.
    """
    day = F.to_date(parse_time(time))
    sums = []
    for name, c in means.items():
        sums += [F.sum(F.coalesce(c, F.lit(0.0))).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n")]
    return (
        df.filter(F.col(entity).isNotNull())
        .select(F.col(entity), day.alias("day"), *[F.col(c) for c in dict.fromkeys(means.values())])
        .groupBy(entity, "day")
        .agg(F.count("day").alias("day_incidents"), *sums)
        .filter(F.col("day_incidents") > 0)
    )


def added_up(days: DataFrame, entity: str = "state") -> DataFrame:
    """Sums of several ``day_sums`` of the same day, put together."""
    sums = [c for c in days.columns if c not in (entity, "day")]
    return days.groupBy(entity, "day").agg(*[F.sum(c).alias(c) for c in sums])


def moments(days: DataFrame, entity: str = "state", metric: str = "day_incidents") -> DataFrame:
    """Per entity over the rows given: ``n``, ``mean``, and ``m2``, the sum of squared deviations."""
    value = F.col(metric).cast("double")
    return days.groupBy(entity).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count("*")).alias("m2")
    )


def merged(one: DataFrame, other: DataFrame, entity: str = "state", sign: int = 1) -> DataFrame:
    """Moments of two separate sets of rows together; with ``sign`` -1, of ``one`` without ``other``, a part of it.

    By Chan's rule: n = a + b, mean = (a m + b k) / n, and m2 adds (m - k)^2 a b / n.
    An entity of which nothing is left is left out.
    """
    a = one.select(F.col(entity), F.col("n").alias("a"), F.col("mean").alias("am"), F.col("m2").alias("a2"))
    b = other.select(F.col(entity), (F.lit(sign) * F.col("n")).alias("b"), F.col("mean").alias("bm"), (F.lit(sign) * F.col("m2")).alias("b2"))
    a_n, b_n = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    n = a_n + b_n
    a_mean, b_mean = F.coalesce("am", "bm"), F.coalesce("bm", "am")
    # From a's mean a step towards b's: exact where either side is empty.
    mean = a_mean + (b_mean - a_mean) * b_n / n
    m2 = F.coalesce("a2", F.lit(0.0)) + F.coalesce("b2", F.lit(0.0)) + F.pow(b_mean - a_mean, 2) * a_n * b_n / n
    # Where nothing deviates, what is left of taking out is rounding.
    m2 = F.when(n <= 1, F.lit(0.0)).otherwise(F.greatest(m2, F.lit(0.0)))
    return a.join(b, entity, "full").filter(n > 0).select(entity, n.alias("n"), mean.alias("mean"), m2.alias("m2"))


class History:
    """Days and moments below a folder, in numbered versions; the last whole one counts.

    A version's days are an addition to those before; its moments are all moments.
    An update that dies leaves an incomplete version, which the next one replaces.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, entity: str = "state", time: str = "start_time", means: Mapping[str, str] = WEATHER):
        self.spark, self.path, self.entity, self.time, self.means = spark, path.rstrip("/"), entity, time, dict(means)

    def version(self) -> int:
        """The last whole version; 0 if there is none. Moments are written last, so they mark it."""
        return max((int(v) for v in children(self.spark, f"{self.path}/{_MOMENTS}") if self._whole(f"{_MOMENTS}/{v}")), default=0)

    def _whole(self, part: str) -> bool:
        return path_exists(self.spark, f"{self.path}/{part}/_SUCCESS")

    def _additions(self) -> list[int]:
        """Versions whose days make up the present ones: from the last that holds all days on."""
        now = self.version()
        found = sorted(v for v in map(int, children(self.spark, f"{self.path}/{_DAYS}")) if v <= now)
        wholes = [v for v in found if path_exists(self.spark, f"{self.path}/{_DAYS}/{v}/_all")]
        return [v for v in found if not wholes or v >= wholes[-1]]

    def days(self) -> DataFrame:
        """Sums per entity and day so far."""
        return added_up(self._day_rows(), self.entity)

    def _day_rows(self) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{_DAYS}/{v}" for v in self._additions()])

    def moments(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{_MOMENTS}/{self.version()}")

    def absorb(self, rows: DataFrame) -> int:
        """Take in new rows, of new days or old ones; returns the new version (several actions).

        Reads the new rows once. Of the days so far it reads those between the
        first and last new one, by the statistics of their files.
        """
        now = self.version()
        new = now + 1
        place = f"{self.path}/{_DAYS}/{new}"
        day_sums(rows, self.entity, self.time, self.means).sort("day").write.mode("overwrite").parquet(place)
        came = self.spark.read.parquet(place)
        found = moments(came, self.entity)
        if now:
            span = came.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
            within = F.col("day").between(F.lit(span["first"]), F.lit(span["last"])) if span["first"] else F.lit(False)
            known = added_up(self._day_rows().filter(within), self.entity).join(came.select(self.entity, "day"), [self.entity, "day"], "left_semi")
            after = added_up(known.unionByName(came), self.entity)
            found = merged(merged(self.moments(), moments(known, self.entity), self.entity, -1), moments(after, self.entity), self.entity)
        found.write.mode("overwrite").parquet(f"{self.path}/{_MOMENTS}/{new}")
        return new

    def compact(self) -> None:
        """The days of all additions as one (an action); earlier ones can go once nothing reads them."""
        additions = self._additions()
        if len(additions) < 2:
            return
        new = self.version() + 1
        place = f"{self.path}/{_DAYS}/{new}"
        self.days().sort("day").write.mode("overwrite").parquet(place)
        self.spark.range(1).write.mode("overwrite").parquet(f"{place}/_all")
        self.moments().write.mode("overwrite").parquet(f"{self.path}/{_MOMENTS}/{new}")

    def prune(self) -> None:
        """Remove what no present version reads."""
        now, kept = self.version(), set(self._additions())
        for part, keep in ((_DAYS, kept), (_MOMENTS, {now})):
            for v in children(self.spark, f"{self.path}/{part}"):
                if int(v) not in keep:
                    remove_path(self.spark, f"{self.path}/{part}/{v}")

    def anomalies(self, sigmas: float = SIGMAS, since: str | None = None) -> DataFrame:
        """Days (from ``since`` on) strictly above mean + ``sigmas`` deviations of all their entity's days.

        The rows of ``anomaly.sigma_anomalies`` over the daily rollup of all rows taken in.
        """
        rows = self._day_rows() if since is None else self._day_rows().filter(F.col("day") >= F.lit(since).cast("date"))
        std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
        threshold = F.col("mean") + F.lit(float(sigmas)) * std
        measures = [self._mean(name).alias(name) for name in self.means]
        return (
            added_up(rows, self.entity)
            .join(self.moments(), self.entity)
            .select(self.entity, "day", "day_incidents", *measures, F.col("mean").alias("hist_mean"), std.alias("hist_std"), threshold.alias("threshold"))
            .filter(F.col("day_incidents") > F.col("threshold"))
        )

    @staticmethod
    def _mean(name: str) -> Column:
        return F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum") / F.col(f"{name}_n"))
