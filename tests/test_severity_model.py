import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from roadpulse.operators import severity_model as model
from roadpulse.sources import tables


@pytest.fixture(scope="module")
def features(spark, small):
    return model.feature_frame(tables.incidents(spark, small))


def test_rows_with_a_gap_are_dropped(spark):
    df = spark.createDataFrame(
        [(1, 2, 1.0), (2, None, 1.0), (3, 4, None), (4, 4, float("nan"))], "event_id long, severity long, x double"
    )
    rows = model.feature_frame(df, numeric=["x"], categorical=[]).collect()
    assert [(r["event_id"], r["label"]) for r in rows] == [(1, 1)]


def test_split_depends_on_the_key_alone(features):
    train, test = model.split(features)
    again, _ = model.split(features.repartition(13))
    assert train.select("event_id").exceptAll(again.select("event_id")).isEmpty()
    assert train.count() + test.count() == features.count()
    assert 0.78 < train.count() / features.count() < 0.82
    assert model.split(features, share=0.5)[0].count() < train.count()
    everything, nothing = model.split(features, share=1.0)
    assert everything.count() == features.count() and nothing.isEmpty()


def test_category_order(spark):
    df = spark.createDataFrame([(c,) for c in ["b", "b", "a", "a", "c", "c", "c", "d"]], "c string")
    got = {r["category"]: r["category_index"] for r in model.category_index(df, ["c"]).collect()}
    assert got == {"c": 0, "a": 1, "b": 2, "d": 3}


def test_category_index_is_that_of_the_indexer(features):
    fitted = model.indexer().fit(features)
    want = {(c, label): i for c, labels in zip(model.CATEGORICAL, fitted.labelsArray) for i, label in enumerate(labels)}
    got = {(r["feature"], r["category"]): r["category_index"] for r in model.category_index(features).collect()}
    assert got == want


def test_many_categories(spark):
    """No number of categories is refused, and none is left out."""
    df = spark.range(12_000).selectExpr("CAST(id AS STRING) AS c")
    assert model.category_index(df, ["c"]).agg(F.max("category_index")).first()[0] == 11_999


def test_rows_without_a_key_are_tested(spark):
    df = spark.createDataFrame([(i if i % 2 else None, 1) for i in range(200)], "k long, label long")
    train, test = model.split(df, "k")
    counts = {r["part"]: r["n"] for r in model.split_counts(df, "k").collect()}
    assert counts == {"train": train.count(), "test": test.count()} and sum(counts.values()) == 200
    assert train.filter("k IS NULL").isEmpty()


def test_quality_equals_the_evaluator(features):
    predictions = model.threshold_prediction(features)
    row = model.quality(model.confusion(predictions)).first()
    for metric, got in (("accuracy", row["accuracy"]), ("f1", row["weighted_f1"])):
        evaluator = MulticlassClassificationEvaluator(metricName=metric)
        typed = predictions.withColumn("label", F.col("label").cast("double"))
        assert got == pytest.approx(evaluator.evaluate(typed), abs=1e-12)


def test_quality_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0), (1, 0.0), (2, 3.0)], "label long, prediction double")
    row = model.quality(model.confusion(df)).first()
    assert row["accuracy"] == 0.5
    assert row["weighted_f1"] == pytest.approx(0.5 * 0.8)


@pytest.fixture(scope="module")
def trained(features):
    return model.train_and_predict(features)


def test_tree_beats_chance_on_unseen_rows(features, trained):
    row = model.quality(model.confusion(trained.predictions)).first()
    assert row["accuracy"] > 0.9 and row["weighted_f1"] > 0.9
    _, test = model.split(features)
    assert trained.predictions.count() == test.count()


def test_tree_settings(trained):
    tree = trained.model.stages[-1]
    assert (tree.getMaxBins(), tree.getMaxDepth(), tree.getImpurity()) == (60, 5, "gini")
    assert tree.numClasses == 4


def test_unseen_category(features, trained):
    strange = features.limit(3).withColumn("state", F.lit("elsewhere"))
    assert trained.model.transform(strange).filter(F.col("prediction").isNotNull()).count() == 3
    strict = model.build_pipeline(unseen="error").fit(features)
    with pytest.raises(Exception, match="(?i)unseen label"):
        strict.transform(strange).collect()
