"""Estimators with their parameter presets."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

SEED = 1234567

# The full parameter grids and fold counts of the preset searches.
GRIDS: dict[str, dict[str, list]] = {
    "linear_regression": {
        "maxIter": [1000],
        "regParam": [0.001],
        "tol": [1e-6],
        "elasticNetParam": [0.001],
    },
    "gbt_regression": {"maxIter": [10], "maxDepth": [10], "maxBins": [5, 7, 9]},
    "forest_regression": {"numTrees": [5], "maxDepth": [10], "maxBins": [23]},
    "logistic": {"maxIter": [100], "regParam": [1.0], "tol": [1e-8], "elasticNetParam": [1.0]},
    "svm": {"maxIter": [1000], "regParam": [0.1], "tol": [1e-4]},
    "churn_tree": {
        "impurity": ["gini", "entropy"],
        "maxBins": [3, 5, 9, 15, 23, 31],
        "maxDepth": [5, 10, 15, 20, 25, 30],
    },
    "churn_forest": {
        "maxDepth": [5, 10, 15, 20, 25, 30],
        "featureSubsetStrategy": ["auto", "all"],
        "impurity": ["gini", "entropy"],
        "maxBins": [3, 5, 10, 15, 25, 35, 45],
        "numTrees": [10, 50, 100],
    },
    "cover_tree": {
        "impurity": ["gini", "entropy"],
        "maxDepth": [1, 20],
        "maxBins": [40, 300],
        "minInfoGain": [0.0, 0.05],
    },
    "cover_forest": {"minInfoGain": [0.0, 0.05], "numTrees": [1, 10]},
    "text": {"numFeatures": [10, 100, 1000], "regParam": [0.1, 0.01]},
}
FOLDS = {"text": 2}
DEFAULT_FOLDS = 10
TRAIN_RATIO = 0.9


def folds_of(preset: str) -> int:
    return FOLDS.get(preset, DEFAULT_FOLDS)


def estimator(
    kind: str, features: str = "features", label: str = "label", seed: int = SEED, **params
) -> Estimator:
    """Estimator by name; ``params`` are Spark ML parameter names."""
    kinds = {
        "linear_regression": LinearRegression,
        "gbt_regression": GBTRegressor,
        "forest_regression": RandomForestRegressor,
        "logistic": LogisticRegression,
        "svm": LinearSVC,
        "tree": DecisionTreeClassifier,
        "forest": RandomForestClassifier,
    }
    made = kinds[kind](featuresCol=features, labelCol=label, **params)
    return made.setSeed(seed) if made.hasParam("seed") else made
