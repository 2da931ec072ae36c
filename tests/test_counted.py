"""Least-squares searches over counted rows against the rows themselves."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from tallywood.learning import features, tuning


@pytest.fixture(scope="module")
def rows(spark):
    frame = spark.range(3000).select(
        "id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") * 31 % 11).cast("double").alias("b"),
        ((F.col("id") % 7) * (F.col("id") * 31 % 11) + F.col("id") % 5).cast("double").alias("label"),
    )
    return features.assemble(frame, ["a", "b"])


def test_counted_rows_are_few_and_fit_the_same_model(rows):
    fold = (F.col("id") % 2).cast("int")
    counted = tuning.counted_rows(rows, fold, apart=False).cache()
    assert counted.count() <= 2 * 7 * 11
    assert counted.agg(F.sum("weight")).head()[0] == 3000
    for model in (DecisionTreeRegressor(maxDepth=4), GBTRegressor(maxDepth=3, maxIter=4, seed=1)):
        plain = model.fit(rows).transform(rows)
        ours = model.copy().setWeightCol("weight").fit(counted)
        both = plain.select("id", "prediction").join(
            ours.transform(rows).select("id", F.col("prediction").alias("counted")), "id"
        )
        assert both.where(F.abs(F.col("prediction") - F.col("counted")) > 1e-9).count() == 0
        error = tuning.CountedError().evaluate(ours.transform(counted))
        assert error == pytest.approx(RegressionEvaluator().evaluate(plain))


def test_labels_stay_apart_for_models_that_draw(rows):
    counted = tuning.counted_rows(rows, F.lit(0), apart=True)
    assert counted.count() == rows.select("a", "b", "label").distinct().count()
    assert counted.agg(F.max("within")).head()[0] == 0


def test_search_reads_counted_rows_whatever_the_folds_hold(rows):
    model = DecisionTreeRegressor()
    grid = tuning.param_grid({"maxDepth": [1, 6]}, model)
    best = tuning.cross_validate_counted(rows, ["id"], model, grid, 3, 5, draws=False)
    assert best.avgMetrics[1] < best.avgMetrics[0] and best.bestModel.getMaxDepth() == 6
    few = rows.where("id IN (1, 2, 3, 4, 5, 6)")
    assert len(tuning.cross_validate_counted(few, ["id"], model, grid, 10, 5, draws=True).avgMetrics) == 2
