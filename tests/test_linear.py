"""Linear models from sums against Spark ML's and against their rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tallywood.learning import linear

NAMES = ["a", "b", "c", "constant"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    data = []
    for i in range(400):
        a, b = rng.normal(50, 4), rng.normal()
        c = 0.5 * a + rng.normal()
        data.append((i % 5, a, b, c, 7.0, 3 * a - 2 * b + 0.1 * c + rng.normal()))
    return spark.createDataFrame(data, "part int, a double, b double, c double, constant double, y double")


@pytest.mark.parametrize(("penalty", "mix"), [(0.0, 0.0), (0.001, 0.001), (0.5, 0.0), (0.3, 0.5), (2.0, 1.0)])
def test_equals_spark_ml(rows, penalty, mix):
    sums = linear.matrices(linear.fold_sums(rows, NAMES, "y", "part"), 6)
    found = linear.solve(sum(sums.values()), NAMES, penalty, mix)
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    model = LinearRegression(
        labelCol="y", regParam=penalty, elasticNetParam=mix, maxIter=1000, tol=1e-12
    ).fit(vectors)
    assert found.coefficients == pytest.approx(model.coefficients.toArray(), abs=1e-6)
    assert found.intercept == pytest.approx(model.intercept, abs=1e-5)


def test_folds_equal_models_fitted_on_the_other_rows(rows):
    grid = [(0.0, 0.0), (0.3, 0.5)]
    by_fold = linear.matrices(linear.fold_sums(rows, NAMES, "y", "part"), 6)
    board, best = linear.cross_validated(by_fold, NAMES, grid)
    assert len(board) == 10
    assembler = VectorAssembler(inputCols=NAMES, outputCol="features")
    for penalty, mix, fold, n_train, n_test, rmse in board:
        if fold not in (0, 3):
            continue
        train = assembler.transform(rows.where(F.col("part") != fold))
        held = assembler.transform(rows.where(F.col("part") == fold))
        model = LinearRegression(labelCol="y", regParam=penalty, elasticNetParam=mix, tol=1e-12).fit(train)
        assert (n_train, n_test) == (train.count(), held.count())
        assert rmse == pytest.approx(model.evaluate(held).rootMeanSquaredError, abs=1e-6)
    scored = rows.withColumn("p", best.prediction())
    error = scored.agg(F.sum((F.col("y") - F.col("p")) ** 2)).first()[0]
    assert error == pytest.approx(best.squared_error(sum(by_fold.values())), rel=1e-6)
    table = {r.feature: r.weight for r in linear.coefficient_table(rows, best).collect()}
    assert table[None] == best.intercept and table["constant"] == 0.0 and len(table) == 5


def test_many_sums_are_several_aggregates(rows, monkeypatch):
    whole = sorted(linear.fold_sums(rows, NAMES, "y", "part").collect())
    monkeypatch.setattr(linear, "SUMS_AT_ONCE", 4)
    split = sorted(linear.fold_sums(rows, NAMES, "y", "part").collect())
    assert [r[:3] for r in whole] == [r[:3] for r in split] and len(whole) == 5 * 21
    assert [r[3] for r in whole] == pytest.approx([r[3] for r in split])


def test_odd_rows(spark):
    data = [(0, 1.0, 2.0), (0, None, 5.0), (1, 2.0, None), (1, float("nan"), 1.0), (1, 3.0, 2.0)]
    frame = spark.createDataFrame(data, "fold int, v1 double, y double")
    sums = linear.matrices(linear.fold_sums(frame, ["v1"], "y", "fold"), 3)
    assert {f: m[0, 0] for f, m in sums.items()} == {0: 1.0, 1: 1.0}
    # A constant label: the model is that constant.
    board, model = linear.cross_validated(sums, ["v1"], [(0.1, 0.5)])
    assert model.intercept == 2.0 and model.coefficients.tolist() == [0.0]
    assert [r[5] for r in board] == [0.0, 0.0]
    empty = linear.matrices(linear.fold_sums(frame.limit(0), ["v1"], "y", "fold"), 3)
    board, model = linear.cross_validated(empty, ["v1"], [(0.1, 0.5)])
    assert empty == {} and board == [] and model.intercept == 0.0


@pytest.mark.parametrize("penalty", [0.0, 0.1, 2.0])
def test_logistic_equals_spark_ml(rows, penalty):
    labelled = rows.withColumn("y", (F.col("y") + 6 * F.sin(F.col("a") * 50) > 155).cast("double"))
    found = linear.fit_logistic(labelled, NAMES, "y", penalty)
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(labelled)
    model = LogisticRegression(labelCol="y", regParam=penalty, maxIter=1000, tol=1e-13).fit(vectors)
    assert found.coefficients == pytest.approx(model.coefficients.toArray(), abs=2e-5, rel=1e-4)
    assert found.intercept == pytest.approx(model.intercept, rel=1e-4)
    chance = 1 / (1 + F.exp(-found.prediction()))
    scored = vectors.withColumn("chance", chance)
    theirs = {r.id: r.probability[1] for r in model.transform(scored.withColumn("id", F.xxhash64("a"))).collect()}
    for r in scored.withColumn("id", F.xxhash64("a")).collect():
        assert r.chance == pytest.approx(theirs[r.id], abs=1e-5)


def test_logistic_of_odd_rows(spark):
    data = [(1.0, 1.0), (2.0, 0.0), (3.0, 1.0), (None, 1.0), (float("nan"), 0.0), (4.0, None)]
    frame = spark.createDataFrame(data, "a double, y double")
    found = linear.fit_logistic(frame, ["a"], "y", 0.1)
    assert found.coefficients == pytest.approx([0.0], abs=1e-9)
    assert found.intercept == pytest.approx(np.log(2))
    one = linear.fit_logistic(frame.where("y = 1"), ["a"], "y", 0.1)
    assert one.intercept == float("inf") and one.coefficients.tolist() == [0.0]
    none = linear.fit_logistic(frame.limit(0), ["a"], "y", 0.1)
    assert none.intercept == 0.0
