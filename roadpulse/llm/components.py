"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.sources.shared_dir import collected, hand_over, remove_paths, written


def connected_components(links: DataFrame) -> DataFrame:
    """(``v``, ``label``): smallest vertex reachable from each vertex of ``links`` (``a``, ``b``); one action a round.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so paths halve. Rounds are written to the shared folder, which
    cuts the lineage; each one's table goes when the next is written.
    """
    spark = links.sparkSession
    with collected() as link_paths:
        both = written(links.select(F.col("a").alias("v"), F.col("b").alias("w")).union(links.select("b", "a")).distinct(), "links")
    with collected() as old:
        labels = written(both.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("w"), "label"), "w").groupBy("v").agg(F.min("label").alias("near"))
        lower = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("root"))
        step = lower.join(jump, "label").select("v", "old", F.least("label", "root").alias("label"))
        with collected() as new:
            step = written(step, "labels")
        remove_paths(spark, old)
        labels, old = step.select("v", "label"), new
        if step.filter("old <> label").isEmpty():
            break
    remove_paths(spark, link_paths)
    hand_over(old)
    return labels
