"""Estimator presets (J1-J10). All are stock ``pyspark.ml`` estimators; the presets hold the reference's settings.

A training run uses the forest of its version (v1: 100 x 10, v2: 200 x 15, v3: 300 x 20); ``default`` is Spark's own
(20 trees, depth 5), as in the reference's simple notebook cells.
"""

from __future__ import annotations

from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor

SEED = 42

#: Groups of nodes after which a forest's cached node ids are checkpointed.
CHECKPOINT_INTERVAL = 25

# Forest settings of the three variants.
RF_PRESETS: dict[str, dict] = {
    "default": {},
    "v1": {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2, "subsamplingRate": 0.8,
           "featureSubsetStrategy": "auto"},
    "v2": {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 1, "subsamplingRate": 0.9,
           "featureSubsetStrategy": "sqrt", "maxBins": 64},
    "v3": {"numTrees": 300, "maxDepth": 20, "minInstancesPerNode": 1, "subsamplingRate": 0.8,
           "featureSubsetStrategy": "sqrt"},
}


def rf_classifier(preset: str = "default", features_col: str = "features", label_col: str = "label",
                  seed: int = SEED, **overrides) -> RandomForestClassifier:
    """J5-J8. The versions' and tuned forests keep each row's node in every tree between levels (``cacheNodeIds``) instead of
    sending the trees and walking them anew for every group of nodes; the trees are the same."""
    params = {**RF_PRESETS[preset], **overrides}
    if preset != "default" or overrides:
        params = {"cacheNodeIds": True, "checkpointInterval": CHECKPOINT_INTERVAL, **params}
    return RandomForestClassifier(featuresCol=features_col, labelCol=label_col, seed=seed, **params)


def rf_regressor(features_col: str = "features", label_col: str = "Calories_Burned", seed: int = SEED,
                 **params) -> RandomForestRegressor:
    """J4."""
    return RandomForestRegressor(featuresCol=features_col, labelCol=label_col, seed=seed, **params)


def linear_regression(features_col: str = "features", label_col: str = "Calories_Burned",
                      **params) -> LinearRegression:
    """J3."""
    return LinearRegression(featuresCol=features_col, labelCol=label_col, **params)


def logistic_regression(preset: str = "default", features_col: str = "features", label_col: str = "label",
                        **overrides) -> LogisticRegression:
    """J1 (defaults) and J2 (``preset="v3"``: maxIter 100, regParam 0.01)."""
    # The logistic regression settings of v3.
    params = {"v3": {"maxIter": 100, "regParam": 0.01}}.get(preset, {})
    return LogisticRegression(featuresCol=features_col, labelCol=label_col, **{**params, **overrides})


def decision_tree(features_col: str = "features", label_col: str = "label", seed: int = SEED,
                  maxDepth: int = 15, minInstancesPerNode: int = 1, **params) -> DecisionTreeClassifier:  # noqa: N803
    """J9."""
    return DecisionTreeClassifier(featuresCol=features_col, labelCol=label_col, seed=seed, maxDepth=maxDepth,
                                  minInstancesPerNode=minInstancesPerNode, **params)


def mlp(num_features: int, num_classes: int, hidden: tuple[int, ...] = (64, 32), features_col: str = "features",
        label_col: str = "label", seed: int = SEED, maxIter: int = 100,  # noqa: N803
        **params) -> MultilayerPerceptronClassifier:
    """Layers ``[num_features, *hidden, num_classes]``."""
    return MultilayerPerceptronClassifier(featuresCol=features_col, labelCol=label_col, seed=seed, maxIter=maxIter,
                                          layers=[num_features, *hidden, num_classes], **params)


def v3_models(num_features: int, num_classes: int, rf_preset: str = "v3", dt_depth: int = 15,
              mlp_iter: int = 100) -> dict:
    """J12's model set, multiclass only (J14: no GBT). Ordered: the first wins accuracy ties in J13."""
    return {
        "Random Forest": rf_classifier(rf_preset),
        "Decision Tree": decision_tree(maxDepth=dt_depth),
        "Logistic Regression": logistic_regression("v3"),
        "Neural Network": mlp(num_features, num_classes, maxIter=mlp_iter),
    }
