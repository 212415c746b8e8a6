import math

import numpy as np
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.sql import functions as F

from pulsekit.operators import evaluate as ev


def preds(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")


def test_metrics_match_spark_evaluators(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 4, 600)
    p = np.where(rng.random(600) < 0.6, y, rng.integers(0, 5, 600))  # class 4 is only ever predicted
    df = preds(spark, zip(y, p))
    ours = ev.classification_metrics(df).first()
    for name, metric in [("accuracy", "accuracy"), ("f1_score", "f1"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall")]:
        ref = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert math.isclose(ours[name], ref, rel_tol=1e-12), name


def test_perfect_and_all_wrong(spark):
    perfect = ev.classification_metrics(preds(spark, [(0, 0), (1, 1), (2, 2)])).first()
    assert perfect["accuracy"] == 1.0 and perfect["f1_score"] == 1.0
    wrong = ev.classification_metrics(preds(spark, [(0, 1), (1, 0)])).first()
    assert wrong["accuracy"] == 0.0 and wrong["precision"] == 0.0
    per = {r["class"]: r for r in ev.per_class_metrics(preds(spark, [(0, 1), (1, 1)])).collect()}
    assert per[0.0]["precision"] == 0.0 and per[0.0]["recall"] == 0.0 and per[1.0]["precision"] == 0.5


def test_confusion_matrix_is_dense_and_named(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "label string, prediction string")
    cm = {(r["actual"], r["predicted"]): r["count"] for r in ev.confusion_matrix(df).collect()}
    assert len(cm) == 9 and cm[("a", "b")] == 1 and cm[("b", "b")] == 0


def test_auc_matches_binary_evaluator(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 500)
    s = (y * 0.7 + rng.random(500)).round(2)  # ties
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, s)], "label double, score double")
    ours = ev.auc_roc(df, "label", "score", 1.0, num_partitions=3).first()["auc"]
    vec = df.select("label", F.array(-F.col("score"), F.col("score")).alias("a"))
    from pyspark.ml.functions import array_to_vector
    ref = BinaryClassificationEvaluator(rawPredictionCol="raw", numBins=0).evaluate(
        vec.select("label", array_to_vector("a").alias("raw")))
    assert math.isclose(ours, ref, rel_tol=1e-9)


def test_regression_metrics_match_evaluator(spark):
    rng = np.random.default_rng(6)
    y = rng.normal(100, 10, 200)
    p = y + rng.normal(0, 3, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, prediction double")
    ours = ev.regression_metrics(df, "y").first()
    for name, metric in [("RMSE", "rmse"), ("R2", "r2"), ("MAE", "mae")]:
        ref = RegressionEvaluator(labelCol="y", metricName=metric).evaluate(df)
        assert math.isclose(ours[name], ref, rel_tol=1e-9), name


def test_predicted_label_without_udf(spark):
    df = preds(spark, [(0, 0), (0, 1), (0, 7)])
    got = [r["predicted_label"] for r in ev.with_predicted_label(df, ["Cardio", "Yoga"]).orderBy("prediction").collect()]
    assert got == ["Cardio", "Yoga", "Unknown"]


def test_overfitting_gap(spark):
    df = spark.createDataFrame([("train", 1.0, 1.0), ("train", 1.0, 1.0), ("test", 1.0, 0.0), ("test", 1.0, 1.0)],
                               "split string, label double, prediction double")
    row = ev.overfitting_gap(df).first()
    assert row["gap"] == 0.5 and row["overfitting"] and row["verdict"] == "MODERATE"


def test_confusion_matrix_of_many_classes_and_given_classes(spark):
    df = spark.range(6000).select((F.col("id") % 1500).cast("double").alias("label"), (F.col("id") * 7 % 1501).cast("double").alias("prediction"))
    dense = ev.confusion_matrix(df)
    one = dense.agg(F.count(F.lit(1)).alias("cells"), F.sum("count").alias("n"), F.count_if(F.col("count") > 0).alias("seen"),
                    F.count_distinct("actual").alias("k")).first()
    assert (one["cells"], one["n"], one["k"]) == (1501 * 1501, 6000, 1501)
    assert one["seen"] == ev.confusion_counts(df).count()
    given = {(r["actual"], r["predicted"]): r["count"] for r in ev.confusion_matrix(df, classes=[0, 7, 9999]).collect()}
    assert len(given) == 9 and given[0.0, 0.0] == 1 and given[9999.0, 7.0] == 0
    assert ev.confusion_matrix(df.limit(0)).count() == 0
    many = spark.range(50_000).select(F.col("id").cast("string").alias("label"), F.col("id").cast("string").alias("prediction"))
    assert ev.confusion_counts(many).count() == 50_000


def test_confusion_grid_is_not_shuffled(spark, monkeypatch):
    """The grid's rows are made by the last step of the plan; what is shuffled before is a row per two blocks."""
    monkeypatch.setattr(ev, "GRID_CLASSES", 10)
    df = spark.createDataFrame([(f"c{k % 45}", f"c{k * k % 61}") for k in range(400)] + [("c1", None), (None, "c1")], "label string, prediction string")
    dense = ev.confusion_matrix(df)
    assert dense._jdf.queryExecution().optimizedPlan().toString().startswith("MapInArrow")
    got = {(r["actual"], r["predicted"]): r["count"] for r in dense.collect()}
    want = {}
    for k in range(400):
        want[f"c{k % 45}", f"c{k * k % 61}"] = want.get((f"c{k % 45}", f"c{k * k % 61}"), 0) + 1
    names = {c for pair in want for c in pair}
    assert got == {(a, b): want.get((a, b), 0) for a in names for b in names} and dense.count() == len(names) ** 2
