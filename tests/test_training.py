from pyspark.sql import functions as F

from pulsekit.operators import clean as cl
from pulsekit.plans import estimators as es
from pulsekit.plans import training as tr
from pulsekit.plans.preprocessing import preprocessing_stages
from pulsekit.sources.fixtures import activity
from tests.conftest import SF_SMALL


def test_tune_returns_grid_params_only(spark):
    data = cl.clean(activity(spark, SF_SMALL), cl.LOOSE_RULES)
    stages = preprocessing_stages(["Steps", "Heart_Rate_avg", "Calories_Burned"], scaler=None)
    _, best = tr.tune_random_forest(data, stages, grid={"numTrees": [2, 3], "maxDepth": [2]}, folds=2)
    assert set(best) == {"numTrees", "maxDepth"} and best["numTrees"] in (2, 3)
    es.rf_classifier(**best)  # usable as keyword arguments


def test_train_classifier_v3_comparison(spark):
    cfg = tr.TrainConfig(version="v3", rules=dict(cl.STRICT_RULES), balance="undersample", compare=True, rf_preset="default")
    res = tr.train_classifier(activity(spark, SF_SMALL), cfg)
    rows = res.comparison.orderBy("position").collect()
    assert [r["model"] for r in rows] == ["Random Forest", "Decision Tree", "Logistic Regression", "Neural Network"]
    best = tr.best_model_row(res.comparison).first()
    assert best["accuracy"] == max(r["accuracy"] for r in rows)
    assert len(res.feature_names) == 18
    assert res.test_predictions.where(F.col("predicted_label") == "Unknown").count() == 0


def test_train_classifier_v1_metrics_both_splits(spark):
    res = tr.train_classifier(activity(spark, SF_SMALL), tr.TrainConfig(version="v1", rf_preset="default"))
    splits = {r["split"]: r for r in res.metrics.collect()}
    assert set(splits) == {"train", "test"} and all(0 <= r["accuracy"] <= 1 for r in splits.values())


def test_train_classifier_logs_and_saves(spark, tmp_out):
    import os

    from pulsekit.sources import runs
    log = runs.RunLog(spark, os.path.join(tmp_out, "runs"), run_id="t1")
    path = os.path.join(tmp_out, "model")
    res = tr.train_classifier(activity(spark, SF_SMALL), tr.TrainConfig(version="v2", rf_preset="default"), run_log=log, model_path=path)
    keys = {r["key"] for r in log.read().collect()}
    assert {"version", "feature_columns", "class_labels", "test_accuracy", "train_f1_score"} <= keys
    model, sig = runs.load_model(spark, path)
    assert {"num_classes", "train_samples", "test_samples", "rf_numTrees", "rf_maxDepth", "overfitting_gap"} <= keys
    assert sig.fieldNames() == ["Steps", "Heart_Rate_avg", "Calories_Burned"]
    unlabelled = cl.clean(activity(spark, SF_SMALL), cl.LOOSE_RULES).select("row_id", *sig.fieldNames())
    scored = tr.score(unlabelled, path)
    assert scored.columns == ["row_id", *sig.fieldNames(), "prediction", "predicted_label"]
    assert scored.count() == unlabelled.count() and res.labels == list(model.stages[0].labels)


def test_v3_model_scores_unlabelled_rows_as_in_training(spark, tmp_out):
    path = f"{tmp_out}/v3"
    cfg = tr.TrainConfig(version="v3", rules=dict(cl.STRICT_RULES), rf_preset="default")
    res = tr.train_classifier(activity(spark, SF_SMALL), cfg, model_path=path)
    data = cl.clean(activity(spark, SF_SMALL), cl.STRICT_RULES).drop("Workout_Type")
    got = {r["row_id"]: (r["prediction"], r["predicted_label"]) for r in tr.score(data, path).collect()}
    want = {r["row_id"]: (r["prediction"], r["predicted_label"]) for r in res.test_predictions.collect()}
    assert want and all(got[k] == v for k, v in want.items())
    res.unpersist()


def test_failed_model_is_reported(spark):
    data = cl.clean(activity(spark, SF_SMALL), cl.LOOSE_RULES)
    stages = preprocessing_stages(["Steps", "Heart_Rate_avg", "Calories_Burned"], scaler=None)
    fitted, failed = tr.train_multiple_models(data, stages, {"tree": es.decision_tree(maxDepth=2), "bad": es.mlp(7, 4, maxIter=1)})
    rows = {r["model"]: r for r in tr.compare_models(fitted, data, failed).collect()}
    assert rows["tree"]["status"] == "ok" and rows["bad"]["status"] == "failed" and rows["bad"]["error"]
    one = fitted["tree"].transform(data)
    assert rows["tree"]["accuracy"] == one.where("label = prediction").count() / one.count()


def test_binary_model_has_an_auc(spark):
    data = activity(spark, SF_SMALL).where(F.col("Workout_Type").isin("Cardio", "None"))
    res = tr.train_classifier(data, tr.TrainConfig(rf_preset="default"))
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    want = BinaryClassificationEvaluator().evaluate(res.test_predictions)
    assert abs(res.auc.first()["auc"] - want) < 0.02


def test_balancing_after_the_split_has_the_right_rates(spark):
    rows = [(k, "big" if k % 10 else "small") for k in range(20000)]
    df = spark.createDataFrame(rows, "row_id long, Workout_Type string")
    from pulsekit.operators import sample as sa
    train, _ = sa.train_test_split(df, "row_id")
    sizes = {r[0]: r[1] for r in train.groupBy("Workout_Type").count().collect()}
    under = {r[0]: r[1] for r in sa.balance(train, "Workout_Type", "undersample").groupBy("Workout_Type").count().collect()}
    assert under["small"] == sizes["small"] and abs(under["big"] - sizes["small"]) < 4 * sizes["small"] ** 0.5
    over = {r[0]: r[1] for r in sa.balance(train, "Workout_Type", "oversample").groupBy("Workout_Type").count().collect()}
    assert over["big"] == sizes["big"] and abs(over["small"] - sizes["big"]) < 4 * (sizes["small"] * 0.25) ** 0.5 + 1


def test_weighted_scores_equal_the_evaluator(spark):
    import random
    from collections import Counter

    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    r = random.Random(3)
    rows = [(float(r.randint(0, 3)), float(r.choice([0, 0, 1, 2, 4]))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    names = ("accuracy", "weightedPrecision", "weightedRecall", "f1")
    want = [MulticlassClassificationEvaluator(metricName=n).evaluate(df) for n in names]
    assert all(abs(a - b) < 1e-12 for a, b in zip(tr.weighted_scores(Counter(rows)), want, strict=True))


def test_cross_validation_against_single_fits(spark):
    """Every fold and combination once; a fold's metric equals Spark's evaluator on the same fit done alone."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from pulsekit.functions.hashing import hash01
    data = cl.clean(activity(spark, SF_SMALL), cl.LOOSE_RULES)
    stages = preprocessing_stages(["Steps", "Heart_Rate_avg", "Calories_Burned"])
    grid = {"numTrees": [2, 4], "maxDepth": [3], "subsamplingRate": [0.8, 0.9]}
    result = tr.cross_validate(data, stages, grid, folds=2)
    rows = result.folds.collect()
    assert sorted((x["fold"], x["position"]) for x in rows) == [(k, p) for k in range(2) for p in range(4)]
    fold = F.floor(hash01("row_id", 42, purpose="fold") * 2)
    train, valid = (data.where(fold == k) for k in (1, 0))
    prep = Pipeline(stages=stages).fit(train)
    fitted = es.rf_classifier(numTrees=4, maxDepth=3, subsamplingRate=0.9, cacheNodeIds=True) \
        .fit(prep.transform(train).select("label", "features").coalesce(1))
    alone = MulticlassClassificationEvaluator(metricName="f1").evaluate(fitted.transform(prep.transform(valid)))
    (same,) = [x["f1"] for x in rows if (x["fold"], x["position"]) == (0, 3)]
    assert abs(same - alone) < 1e-12
    means = result.means().collect()
    best = result.best()
    assert max(means, key=lambda m: m["avg_f1"])["avg_f1"] == [m["avg_f1"] for m in means if all(m[k] == v for k, v in best.items())][0]


def test_versions_forests_keep_node_ids_and_the_same_trees(spark):
    """A version's forest caches node ids; its trees are those of a fit that walks every tree from its root."""
    from pyspark.ml import Pipeline
    data = cl.clean(activity(spark, SF_SMALL), cl.LOOSE_RULES)
    feats = Pipeline(stages=preprocessing_stages(["Steps", "Heart_Rate_avg", "Calories_Burned"])).fit(data).transform(data)
    for preset in ("v1", "v2", "v3"):
        assert es.rf_classifier(preset).getCacheNodeIds()
    cached, walked = (es.rf_classifier("v2", numTrees=3, **more).fit(feats) for more in ({}, {"cacheNodeIds": False}))
    assert cached.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_a_fit_does_not_run_in_one_task(spark, monkeypatch):
    """Many rows of one input partition are fitted in several; few rows stay in one."""
    one = cl.clean(activity(spark, SF_SMALL), cl.LOOSE_RULES).coalesce(1)
    parts = []

    class Forest:
        def __init__(self, *preset, **params):
            self.inner = es.RandomForestClassifier(numTrees=1, maxDepth=2, seed=1)

        def getNumTrees(self):  # noqa: N802
            return 100

        def fit(self, df):
            parts.append(df.rdd.getNumPartitions())
            return self.inner.fit(df)

    monkeypatch.setattr(es, "rf_classifier", Forest)
    for times in (1, 60):
        many = one.crossJoin(spark.range(times).coalesce(1).withColumnRenamed("id", "copy")).coalesce(1) \
            .withColumn("row_id", F.col("row_id") * times + F.col("copy"))
        tr.train_classifier(many, tr.TrainConfig(version="v1")).unpersist()
    assert parts[0] == 1 and parts[1] > 1


def test_spread_does_not_depend_on_the_input_partitions(spark):
    rows = [(k if k % 3 else None, float(k)) for k in range(500)]
    df = spark.createDataFrame(rows, "row_id long, x double")
    dealt = [tr.spread(d, 500, ["row_id", "x"], 100).rdd.glom().collect() for d in (df.coalesce(1), df.repartition(7))]
    assert dealt[0] == dealt[1] and len(dealt[0]) == 5 and all(dealt[0])
    assert sorted(r["x"] for part in dealt[0] for r in part) == [float(k) for k in range(500)]
    assert tr.spread(df, 14_000_000, ["row_id"], 100).rdd.getNumPartitions() == 26


def test_a_large_forest_is_smaller_ones_side_by_side(spark, monkeypatch, tmp_out):
    """Its trees are those of the smaller fits, each from its own seed; it scores, saves and explains itself as one model."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassificationModel
    data = cl.clean(activity(spark, SF_SMALL), cl.LOOSE_RULES)
    feats = Pipeline(stages=preprocessing_stages(["Steps", "Heart_Rate_avg", "Calories_Burned"])).fit(data).transform(data) \
        .select("label", "features").coalesce(1)
    forest = es.rf_classifier("v1", numTrees=7, maxDepth=4)
    assert tr.forest_parts(forest, 1000) == 1 and tr.forest_parts(es.decision_tree(), 10**9) == 1
    assert tr.forest_parts(forest, 10**6) == 7 and tr.forest_parts(es.rf_classifier("v3"), 13_000) == tr.FOREST_PARTS
    model = tr.fit_forest(forest, feats, 3)
    alone = [es.rf_classifier("v1", numTrees=n, maxDepth=4, seed=es.SEED + k).fit(feats) for k, n in enumerate((3, 2, 2))]
    assert model.getNumTrees == 7 and len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) > 1
    assert [t.toDebugString.split("\n", 1)[1] for t in model.trees] == [t.toDebugString.split("\n", 1)[1] for m in alone for t in m.trees]
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9 and model.numClasses == alone[0].numClasses
    path = f"{tmp_out}/forest"
    model.write().save(path)
    again = RandomForestClassificationModel.load(path)
    both = [[tuple(r) for r in m.transform(feats).select("prediction", "probability").collect()] for m in (model, again)]
    assert both[0] == both[1] and again.getMaxDepth() == 4
    votes = [m.transform(feats).select("rawPrediction").collect() for m in alone]
    assert all(abs(sum(v[0][0] for v in row) - 7 * p[0]) < 1e-9 for row, (_, p) in zip(zip(*votes, strict=True), both[0], strict=True))
    sizes = []
    monkeypatch.setattr(tr, "ROW_TREES_PER_FOREST", 0)
    monkeypatch.setattr(tr, "fit_forest", lambda f, df, parts, fit=tr.fit_forest: (sizes.append((parts, df.rdd.getNumPartitions())), fit(f, df, parts))[1])
    res = tr.train_classifier(activity(spark, SF_SMALL), tr.TrainConfig(version="v1", rf_preset="default"))
    assert sizes == [(8, 1)] and res.model.stages[-1].getNumTrees == 20 and res.metrics.count() == 2
    res.unpersist()


def test_side_by_side_fits_share_the_partitions(spark):
    df = spark.range(10).withColumnRenamed("id", "row_id")
    assert tr.spread(df, 80_000, ["row_id"], 4000).rdd.getNumPartitions() == 12
    assert tr.spread(df, 80_000, ["row_id"], 4000, 8).rdd.getNumPartitions() == 1
    assert tr.spread(df, 5_000_000, ["row_id"], 4000, 8).rdd.getNumPartitions() == 6
