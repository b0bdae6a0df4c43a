"""Places in a sorted table, and the row at a place, without a task that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.sources.shared_dir import written

#: Share of the rows on each side of the cutoff that the first bracket takes in, and the sketch's accuracy.
MARGIN = 0.005
ACCURACY = 10_000


def numbered(rows: DataFrame, order: Sequence[Column], label: str, number: str = "number") -> DataFrame:
    """``rows`` with their place (from 1) in ``order``, a total one (an action).

    Rows are range-sorted and written with their place in their partition; the
    partitions' sizes, as many numbers as there are partitions, give the rest.
    ``rows`` is read twice (ranges are found from a sample), so it should be stored.
    """
    spark = rows.sparkSession
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    in_order = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    in_order = written(in_order.withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    sizes = in_order.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    # One row per partition of the sort, so it fits in every task.
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        in_order.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .select(*[F.col(f"`{c}`") for c in rows.columns], place.alias(number))
    )


class Bracket(NamedTuple):
    """Scores between which the last drawn one lies, and how many rows lie above."""

    low: int
    high: int
    above: int


def bracket(rows: DataFrame, wanted: int, total: int, margin: float = MARGIN, accuracy: int = ACCURACY) -> Bracket:
    """A proven bracket of the ``wanted``-th highest of ``total`` scores (two actions a try).

    The sketch's bounds are guesses. Rows above and inside are counted; if the
    cutoff is not inside, the margin grows fourfold, at last to all scores.
    """
    while True:
        shares = [max(0.0, 1 - wanted / total - margin), min(1.0, 1 - wanted / total + margin)]
        low, high = rows.agg(F.percentile_approx("score", shares, accuracy).alias("q")).head()["q"]
        low, high = (low if shares[0] > 0 else None), (high if shares[1] < 1 else None)
        over = F.lit(False) if high is None else F.col("score") > high
        under = F.lit(False) if low is None else F.col("score") < low
        found = rows.agg(
            F.count_if(over).alias("above"), F.count_if(under).alias("below"), F.min("score").alias("least"), F.max("score").alias("most")
        ).head()
        if found["above"] < wanted <= total - found["below"]:
            return Bracket(found["least"] if low is None else low, found["most"] if high is None else high, found["above"])
        margin *= 4


def kth_highest(rows: DataFrame, wanted: int, total: int, margin: float = MARGIN, accuracy: int = ACCURACY):
    """The ``wanted``-th highest of ``total`` values of ``score`` (several actions); only those in the bracket are sorted.

    ``rows`` is stored and has ``_row``, a number of its own for each row, so that a
    score that many rows have is spread over tasks.
    """
    found = bracket(rows, wanted, total, margin, accuracy)
    inside = rows.filter(F.col("score").between(found.low, found.high)).select("score", "_row")
    in_order = numbered(inside, [F.col("score").desc(), F.col("_row")], "kth-highest")
    return in_order.filter(F.col("number") == wanted - found.above).head()["score"]
