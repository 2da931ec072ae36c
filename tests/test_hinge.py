"""Support vector machines by shared scans against Spark ML's and against their own optimality."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallywood.learning import hinge

NAMES = ["a", "b", "still"]
GRID = {"regParam": [0.1], "maxIter": [1000], "tol": [1e-4]}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 2)) * [3, 0.2] + [50, -1]
    y = (x[:, 0] - 50 + 10 * (x[:, 1] + 1) + rng.normal(size=600) > 1).astype(float)
    data = [(i, float(a), float(b), 4.0, float(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id int, a double, b double, still double, label double").repartition(3).cache()


def height(rows, weights, intercept):
    own = rows.toPandas()
    x, side = own[NAMES].to_numpy(), 2 * own["label"].to_numpy() - 1
    scaled = np.array(weights) * x.std(axis=0, ddof=1)
    return np.maximum(1 - side * (x @ weights + intercept), 0).mean() + 0.05 * float(scaled @ scaled)


def test_whole_model_is_as_good_as_spark(rows):
    board, own = hinge.cross_validated(rows, NAMES, "label", F.col("id") % 5, 5, GRID)
    assert len(board) == 1 and 0.8 < board[0][1] <= 1 and own.coefficients[2] == 0
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    told = LinearSVC(regParam=0.1, maxIter=1000, tol=1e-9).fit(vectors)
    mine, other = height(rows, own.coefficients, own.intercept), height(rows, told.coefficients.toArray(), told.intercept)
    assert mine <= other + 1e-4 and abs(mine - other) < 1e-3
    both = told.transform(vectors).select("prediction", (own.prediction() > 0).cast("double").alias("mine"))
    assert both.where("prediction != mine").count() <= 6


def test_scans_do_not_grow_with_the_models(rows, monkeypatch):
    calls = []
    scan = hinge._sums
    monkeypatch.setattr(hinge, "_sums", lambda *a: calls.append(len(a[1])) or scan(*a))
    hinge.cross_validated(rows, NAMES, "label", F.col("id") % 5, 5, GRID | {"regParam": [0.1, 1.0]})
    assert calls[0] == 12 and len(calls) < 200


def test_one_class_and_no_rows(rows):
    for some in (rows.where("label = 0"), rows.limit(0)):
        _, own = hinge.cross_validated(some, NAMES, "label", F.col("id") % 5, 5, GRID)
        assert some.where(own.prediction() > 0).count() == 0
