"""Mixing sources to target weights by thresholds on a hash of each document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import word_count
from roadpulse.sources.shared_dir import written

# Weights in the order of the sources, share of all words to take, most repeats.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_REPEATS = 2

# Hexadecimal digits that one level of the histogram tells apart (16 ** 3 buckets).
DIGITS = 3
_HASH_DIGITS = 32


def targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most_repeats: int = MOST_REPEATS
) -> DataFrame:
    """Per source: ``source_size``, ``target``, whole ``copies`` of each document and words ``needed`` besides.

    Sources go by code point, null last, and take the weights in turn. A target
    stops at ``most_repeats`` times its source's size. The sources that stop are
    those with the smallest ratio of that bound to the weight, so one ordered
    pass finds the level at which the others share the rest.
    """
    bound = most_repeats * F.col("source_size").cast("double")
    by_name = Window.orderBy(F.col("_source").isNull(), "_source")
    by_ratio = Window.orderBy("ratio", F.col("_source").isNull(), "_source")
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    level = (F.col("all_words") * budget - (F.sum("bound").over(by_ratio) - F.col("bound"))) / F.sum("weight").over(
        by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    return (
        sized.groupBy("_source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
        .withColumn("bound", bound)
        .withColumn("ratio", F.col("bound") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("share", F.first(F.when(F.col("ratio") > F.col("level"), F.col("level")), ignorenulls=True).over(everything))
        .withColumn("target", F.when(F.col("ratio") <= F.col("level"), F.col("bound")).otherwise(F.least(F.col("weight") * F.col("share"), F.col("bound"))))
        .withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).cast("int"))
        .withColumn("needed", F.col("target") - F.col("copies") * F.col("source_size"))
        .select("_source", "source_size", "target", "copies", "needed")
    )


def thresholds(sized: DataFrame, goals: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Per source the hash below which documents give the words ``needed`` (an action per level).

    Each level sums the words per bucket of the next hash digits, finds the
    bucket in which the sum passes what is needed, and goes on with the documents
    of that bucket alone. It ends when every such bucket holds a single hash;
    that document is taken if this comes nearer to the target. Nothing is sorted
    but the buckets of a source.
    """
    goals = written(goals.withColumn("prefix", F.lit("")).withColumn("upto", F.lit(False)), "mix-goals")
    rest, found = sized.select("_source", "size", "hash"), sized.select("_source", F.col("hash").alias("limit"), F.lit(False).alias("upto")).limit(0)
    for start in range(1, _HASH_DIGITS + 1, digits):
        open_goals = goals.select(F.col("_source").alias("s"), F.col("needed"), F.col("prefix"))
        buckets = (
            rest.groupBy("_source", F.substring("hash", start, digits).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.min("hash").alias("first"), F.max("hash").alias("last"))
            .join(open_goals, F.col("_source").eqNullSafe(F.col("s")))
        )
        in_order = Window.partitionBy("_source").orderBy("bucket")
        crossing = (
            buckets.withColumn("before", F.sum("words").over(in_order) - F.col("words"))
            .filter("before <= needed AND needed < before + words")
            .select(
                "_source",
                (F.col("needed") - F.col("before")).alias("needed"),
                F.col("last").alias("only"),
                (F.col("first") == F.col("last")).alias("single"),
                (2 * (F.col("needed") - F.col("before")) >= F.col("words")).alias("upto"),
                F.concat("prefix", "bucket").alias("prefix"),
            )
        )
        crossing = written(crossing, "mix-crossing")
        done = crossing.filter("single").select("_source", F.col("only").alias("limit"), "upto")
        found = found.unionByName(done)
        goals = crossing.filter("NOT single").select("_source", "needed", "prefix")
        if goals.isEmpty():
            break
        wanted = goals.select(F.col("_source").alias("s"), F.col("prefix"))
        inside = F.col("_source").eqNullSafe(F.col("s")) & (F.substring("hash", 1, start + digits - 1) == F.col("prefix"))
        rest = written(rest.join(wanted, inside).select("_source", "size", "hash"), "mix-rest")
    return found


def _hash(doc_id: str, text: str) -> Column:
    """Of the id, or of the text where there is no id."""
    no_id = F.concat(F.lit("text:"), F.coalesce(F.col(text), F.lit("")))
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), no_id))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(``_id``, ``_source``, ``size`` in words, ``hash``) of every document."""
    return docs.select(
        F.col(doc_id).alias("_id"),
        F.col(source).alias("_source"),
        word_count(F.col(text)).alias("size"),
        _hash(doc_id, text).alias("hash"),
    )


def source_limits(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most_repeats: int = MOST_REPEATS
) -> DataFrame:
    """Per source (``_of``): sizes, target, whole copies, and the hash up to which one more is taken."""
    goals = written(targets(sized, weights, budget, most_repeats), "mix-targets")
    limits = thresholds(sized, goals.filter("needed > 0")).withColumnRenamed("_source", "_limited")
    joined = goals.join(limits, F.col("_source").eqNullSafe(F.col("_limited")), "left")
    return written(joined.select(F.col("_source").alias("_of"), "source_size", "target", "copies", "limit", "upto"), "mix-limits")


def _copies(hash_column: str) -> Column:
    at = F.col(hash_column)
    below = (at < F.col("limit")) | ((at == F.col("limit")) & F.col("upto"))
    return F.col("copies") + F.coalesce(below, F.lit(False)).cast("int")


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``taken`` (several actions).

    Sizes are words. Each document is taken ``floor(target / source size)``
    times whole, and once more if its hash is below its source's threshold, so
    a larger target takes a superset of what a smaller one takes, and reruns
    agree. A source's words miss its target by at most half a document. Sources
    without words have target 0. Null text has size 0, the null source is a
    source, rows with one id are taken together, and an empty table gives an
    empty result. Other columns are not read, so their names cannot clash.
    """
    sized = written(measured(docs, doc_id, text, source), "mix-sizes")
    limits = source_limits(sized, weights, budget, most_repeats)
    return sized.join(limits, F.col("_source").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias("doc_id"),
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        (F.col("size") * _copies("hash")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them: 0 to ``most_repeats`` times each."""
    sized = written(measured(docs, doc_id, text, source), "mix-sizes")
    limits = source_limits(sized, weights, budget, most_repeats)
    names = docs.columns
    at = {n: f"c{i}" for i, n in enumerate(names)}
    rows = docs.toDF(*at.values()).withColumn("_hash", _hash(at[doc_id], at[text]))
    return (
        rows.join(limits, F.col(at[source]).eqNullSafe(F.col("_of")))
        .withColumn("_copies", _copies("_hash"))
        .filter("_copies > 0")
        .select(*[F.col(c).alias(n) for n, c in at.items()], F.explode(F.array_repeat(F.lit(1), F.col("_copies"))).alias("_copy"))
        .drop("_copy")
    )
