"""Severity classifier: features, split, MLlib pipeline, quality."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.operators.profile import SAMPLE_ROWS

NUMERIC = ("start_lat", "start_lng", "temperature_f", "humidity_pct", "visibility_mi")
CATEGORICAL = ("sunrise_sunset", "state")

# Bins per feature of the tree, share of rows to train on.
MAX_BINS = 60
TRAIN_SHARE = 0.8


class Trained(NamedTuple):
    model: PipelineModel
    predictions: DataFrame


def feature_frame(
    df: DataFrame,
    keep: Sequence[str] = ("event_id",),
    severity: str = "severity",
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
) -> DataFrame:
    """Rows with severity and every feature present, and ``label = severity - 1``."""
    features = [severity, *numeric, *categorical]
    return (
        df.select(*[c for c in keep if c not in features], *features)
        .dropna(subset=features)
        .withColumn("label", F.col(severity) - 1)
    )


def in_train(key: str | Column, share: float = TRAIN_SHARE) -> Column:
    """Whether a row belongs to the training part, by a hash of its key.

    The first 16 bits of the MD5 are compared with the share, so the answer
    depends on the key alone: not on partitioning, not on a retry. A row without
    a key is never in the training part, and so in the other one.
    """
    key = F.col(key) if isinstance(key, str) else key
    bound = round(share * 0x10000)
    if bound > 0xFFFF:
        return key.isNotNull()
    return F.coalesce(F.substring(F.md5(key.cast("string")), 1, 4) < format(bound, "04x"), F.lit(False))


def split(features: DataFrame, key: str = "event_id", share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    chosen = in_train(key, share)
    return features.filter(chosen), features.filter(~chosen)


def label_counts(features: DataFrame) -> DataFrame:
    return features.groupBy("label").agg(F.count("*").alias("n"))


def split_counts(features: DataFrame, key: str = "event_id", share: float = TRAIN_SHARE) -> DataFrame:
    part = F.when(in_train(key, share), "train").otherwise("test")
    return features.groupBy(part.alias("part"), "label").agg(F.count("*").alias("n"))


def indexer(categorical: Sequence[str] = CATEGORICAL, unseen: str = "keep") -> StringIndexer:
    """Category to number: most frequent first, equal counts by name.

    One stage for all columns, so that fitting counts them in one pass.
    """
    return StringIndexer(
        inputCols=list(categorical),
        outputCols=[f"{c}_index" for c in categorical],
        handleInvalid=unseen,
        stringOrderType="frequencyDesc",
    )


def category_index(features: DataFrame, categorical: Sequence[str] = CATEGORICAL) -> DataFrame:
    """The index that fitting gives to every category of every column.

    One aggregation: the rows are counted per column and category on the map
    side, and only the distinct categories are ordered.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in categorical])
    counts = features.select(F.inline(pairs)).groupBy("feature", "category").agg(F.count("*").alias("n"))
    by_frequency = Window.partitionBy("feature").orderBy(F.desc("n"), "category")
    return counts.select("feature", "category", (F.row_number().over(by_frequency) - 1).cast("long").alias("category_index"))


def build_pipeline(
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    max_bins: int = MAX_BINS,
    unseen: str = "keep",
) -> Pipeline:
    """Index, one-hot encode, assemble, decision tree.

    ``unseen="keep"`` scores a category that training did not contain;
    ``"error"`` makes it fail.
    """
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_onehot" for c in categorical]
    )
    assembler = VectorAssembler(
        inputCols=[*numeric, *encoder.getOutputCols()], outputCol="features", handleInvalid="error"
    )
    tree = DecisionTreeClassifier(labelCol="label", featuresCol="features", maxBins=max_bins)
    return Pipeline(stages=[indexer(categorical, unseen), encoder, assembler, tree])


def train_and_predict(
    features: DataFrame,
    key: str = "event_id",
    share: float = TRAIN_SHARE,
    categorical: Sequence[str] = CATEGORICAL,
    pipeline: Pipeline | None = None,
) -> Trained:
    """Fit on the training part (an action) and score the rest (lazy).

    Fitting reads its rows several times, so they are kept while it runs; lost
    blocks are computed again.
    """
    train, test = split(features, key, share)
    kept = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = (pipeline or build_pipeline(categorical=categorical)).fit(kept)
    finally:
        kept.unpersist()
    return Trained(model, model.transform(test))


def prediction_sample(
    predictions: DataFrame, key: str = "event_id", severity: str = "severity", n: int = SAMPLE_ROWS
) -> DataFrame:
    """Severity, prediction and feature vector of the first ``n`` scored rows."""
    return predictions.orderBy(key).limit(n).select(severity, "prediction", "features")


def assembled_rows(
    features: DataFrame,
    key: str = "event_id",
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
) -> DataFrame:
    """Key, label and the assembled feature vector as an array (fits the indexers)."""
    stages = build_pipeline(numeric, categorical).getStages()[:-1]
    rows = Pipeline(stages=stages).fit(features).transform(features)
    return rows.select(key, "label", vector_to_array("features").alias("features"))


def tree_checks(features: DataFrame, trained: Trained, key: str = "event_id") -> DataFrame:
    """One row of what has to hold for a trained tree, whatever its splits.

    Every test row is scored once, predictions are classes of the training
    labels, and the tree beats always guessing the most frequent class.
    """
    _, test = split(features, key)
    classes = trained.model.stages[-1].numClasses
    scored = trained.predictions.agg(
        F.count("*").alias("scored"),
        F.count_distinct(key).alias("keys"),
        F.min("prediction").alias("least"),
        F.max("prediction").alias("most"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
    )
    guess = test.groupBy("label").count().agg((F.max("count") / F.sum("count")).alias("hits"), F.sum("count").alias("rows")).first()
    return scored.select(
        F.lit(guess["rows"]).alias("tested"),
        "scored",
        (F.col("keys") == F.col("scored")).alias("once"),
        ((F.col("least") >= 0) & (F.col("most") < classes)).alias("known_classes"),
        (F.col("accuracy") > F.lit(guess["hits"])).alias("beats_guessing"),
    )


def threshold_prediction(features: DataFrame, column: str = "temperature_f") -> DataFrame:
    """A fixed rule in place of the tree, whose results SQL can repeat."""
    c = F.col(column)
    rule = F.when(c < 60, 0).when(c < 75, 1).when(c < 90, 2).otherwise(3)
    return features.withColumn("prediction", rule.cast("double"))


def confusion(predictions: DataFrame) -> DataFrame:
    """Rows per label and prediction."""
    return predictions.groupBy("label", F.col("prediction").cast("long").alias("prediction")).agg(
        F.count("*").alias("n")
    )


def quality(confusion_counts: DataFrame) -> DataFrame:
    """Accuracy and F1 weighted by support, from the confusion counts alone.

    The predictions are read once for both measures. Per class,
    F1 = 2 * true positives / (support + predicted).
    """
    hit = F.col("label") == F.col("prediction")
    as_label = F.struct(
        F.col("label").alias("cls"),
        F.col("n").alias("support"),
        F.lit(0).cast("long").alias("predicted"),
        F.when(hit, F.col("n")).otherwise(0).alias("true_positive"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("cls"),
        F.lit(0).cast("long").alias("support"),
        F.col("n").alias("predicted"),
        F.lit(0).cast("long").alias("true_positive"),
    )
    per_class = (
        confusion_counts.select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "true_positive")])
    )
    f1 = 2 * F.col("true_positive") / (F.col("support") + F.col("predicted"))
    total = F.sum("support")
    return per_class.agg(
        (F.sum("true_positive") / total).alias("accuracy"),
        (F.sum(F.col("support") * f1) / total).alias("weighted_f1"),
    )
