"""Statistics and evaluation on fixtures with known values."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest, Correlation
from pyspark.sql import functions as F

from tallywood import stats
from tallywood.functions.special import chi_square_tail
from tallywood.learning import evaluate

ROWS = [(0.5 * i, float(i * i % 7), 3.0, 20.0 - i * 1.5 + i % 3) for i in range(9)]
NAMES = ["d1", "d2", "d3", "d4"]


def matrix(frame):
    return {(r["i"], r["j"]): r["corr"] for r in frame.collect()}


@pytest.mark.parametrize(("method", "name"), [(stats.pearson, "pearson"), (stats.spearman, "spearman")])
@pytest.mark.parametrize("data", [ROWS, ROWS + ROWS[:4]])
def test_correlations_equal_spark_ml(spark, data, method, name):
    frame = spark.createDataFrame(data, NAMES)
    found = matrix(method(frame, NAMES))
    vectors = spark.createDataFrame([(Vectors.dense(r),) for r in data], ["f"])
    ml = Correlation.corr(vectors, "f", name).head()[0].toArray()
    for i, a in enumerate(NAMES):
        for j, b in enumerate(NAMES):
            if (i == 2) != (j == 2):
                assert math.isnan(found[a, b])
            else:
                assert found[a, b] == pytest.approx(ml[i][j], abs=1e-9)


@pytest.mark.parametrize("columns", [16, 17])
def test_no_rows_give_a_whole_matrix(spark, columns):
    names = [f"c{i}" for i in range(columns)]
    empty = spark.createDataFrame([], ", ".join(f"{n} double" for n in names))
    found = matrix(stats.pearson(empty, names))
    assert len(found) == columns**2 and math.isnan(found["c0", "c1"])


def test_sparse_vectors(spark):
    data = [(2.0, 0.0, 0.0, -1.0), (0.0, 3.0, 0.0, 4.0), (5.0, 0.0, 1.0, 0.0), (1.0, 1.0, 0.0, 2.0)]
    sparse = [(Vectors.sparse(4, [(i, v) for i, v in enumerate(r) if v]),) for r in data]
    dense = matrix(stats.pearson(spark.createDataFrame(data, NAMES), NAMES))
    found = matrix(stats.pearson_vectors(spark.createDataFrame(sparse, ["features"]), "features", NAMES))
    assert found == pytest.approx(dense, abs=1e-9)


def test_spearman_with_many_ties_equals_spark_ml(spark):
    frame = spark.range(300).select(
        (F.pmod(F.col("id") * 17, F.lit(10))).cast("double").alias("a"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise((F.col("id") * 31 % 97).cast("double")).alias("b"),
    )
    found = matrix(stats.spearman(frame, ["a", "b"]))
    vectors = frame.select(F.array("a", "b").alias("v"))
    from pyspark.ml.functions import array_to_vector

    ml = Correlation.corr(vectors.select(array_to_vector("v").alias("f")), "f", "spearman")
    assert found["a", "b"] == pytest.approx(ml.head()[0].toArray()[0][1], abs=1e-9)


def test_ranks_of_columns_of_different_types(spark):
    big = 2**60
    rows = [(big, "x", 1.5), (big + 1, "y", 0.5), (big + 1, "x", 1.5), (None, "z", 2.0), (big + 3, "a", 1.5)]
    frame = spark.createDataFrame(rows + rows[:1], "k long, s string, d double")
    found = stats.correlation.average_ranks(frame, ["k", "s", "d"]).collect()
    assert sorted(tuple(r) for r in found) == [
        (1.5, 3.0, 3.5, 2), (3.5, 3.0, 3.5, 1), (3.5, 5.0, 1.0, 1), (5.0, 1.0, 3.5, 1),
    ]
    assert stats.correlation.average_ranks(frame.limit(0), ["k", "d"]).count() == 0


def test_ranks_take_one_join_for_any_number_of_columns(spark, plan_text):
    frame = spark.range(20).select(*[(F.col("id") * (i + 3) % 7).alias(f"c{i}") for i in range(6)])
    plan = plan_text(stats.correlation.average_ranks(frame, frame.columns)).split("(1)")[0]
    # One for the ranks, one for the carries of the running count.
    assert plan.count("Join") <= 2


def test_chi_square_fixture(spark):
    data = [(0, 0.5, 10.0), (0, 1.5, 20.0), (1, 1.5, 30.0)]
    data += [(0, 3.5, 30.0), (0, 3.5, 40.0), (1, 3.5, 40.0)]
    frame = spark.createDataFrame(data, "label int, a double, b double")
    found = {r["feature"]: r for r in stats.chi_square(frame, ["a", "b"], "label").collect()}
    assert (found["a"]["statistic"], found["a"]["dof"]) == (pytest.approx(0.75), 2)
    assert (found["b"]["statistic"], found["b"]["dof"]) == (pytest.approx(1.5), 3)
    tested = {r["feature"]: r for r in stats.chi_square_p_values(frame, ["a", "b"], "label").collect()}
    assert tested["a"]["p_value"] == pytest.approx(0.6873, abs=1e-4)
    assert tested["b"]["p_value"] == pytest.approx(0.6823, abs=1e-4)
    assert tested["b"]["statistic"] == pytest.approx(found["b"]["statistic"])


def test_summaries(spark):
    data = [(Vectors.dense(2, 3, 5), 1.0), (Vectors.dense(4, 6, 7), 2.0)]
    frame = spark.createDataFrame(data, ["features", "weight"])
    weighted = stats.vector_summary(frame, "features", "weight").orderBy("dim").collect()
    assert [r["mean"] for r in weighted] == pytest.approx([3.333333, 5.0, 6.333333], abs=1e-5)
    assert [r["variance"] for r in weighted] == pytest.approx([2.0, 4.5, 2.0])
    plain = stats.vector_summary(frame, "features").orderBy("dim").collect()
    assert [r["mean"] for r in plain] == pytest.approx([3.0, 4.5, 6.0])


def test_baseline_joins_by_class(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "c string")
    test = spark.createDataFrame([("b",), ("c",)], "c string")
    found = stats.baseline_accuracy(train, test, "c").head()["accuracy"]
    assert found == pytest.approx(0.25 * 0.5 + 0.25 * 0.5)


@pytest.fixture(scope="module")
def binary(spark):
    rows = [(1.0, 1.0)] * 30 + [(0.0, 1.0)] * 10 + [(1.0, 0.0)] * 20 + [(0.0, 0.0)] * 40
    return spark.createDataFrame(rows, "label double, prediction double")


def test_outcome_report(binary):
    found = evaluate.outcome_report(binary).head()
    assert (found["total"], found["correct"], found["wrong"]) == (100, 70, 30)
    assert (found["ratio_tp"], found["ratio_fp"], found["ratio_tn"], found["ratio_fn"]) == (
        0.3, 0.1, 0.4, 0.2,
    )
    other = evaluate.outcome_report(binary, positive=0.0).head()
    assert (other["ratio_tp"], other["ratio_tn"]) == (0.4, 0.3)


def test_areas_of_hard_predictions(binary):
    found = evaluate.curve_areas(binary, "prediction").head()
    assert found["area_under_roc"] == pytest.approx(0.70)
    assert found["area_under_pr"] == pytest.approx(0.70)


def test_areas_of_scores_equal_spark_ml(spark):
    frame = spark.range(500).select(
        (F.col("id") * 7919 % 101).cast("double").alias("score"),
        (F.col("id") % 3 == 0).cast("double").alias("label"),
    )
    found = evaluate.curve_areas(frame, "score").head()
    for metric, name in (("areaUnderROC", "area_under_roc"), ("areaUnderPR", "area_under_pr")):
        ml = BinaryClassificationEvaluator(
            rawPredictionCol="score", metricName=metric, numBins=0
        ).evaluate(frame)
        assert found[name] == pytest.approx(ml, abs=1e-12)


def test_threshold_curve(spark):
    frame = spark.createDataFrame(
        [(0.9, 1.0), (0.8, 0.0), (0.7, 1.0), (0.7, 0.0)], "score double, label double"
    )
    found = {r["threshold"]: r for r in evaluate.threshold_curve(frame, "score").collect()}
    assert (found[0.9]["precision"], found[0.9]["recall"]) == (1.0, 0.5)
    assert (found[0.8]["precision"], found[0.8]["recall"]) == (0.5, 0.5)
    assert found[0.7]["f1"] == pytest.approx(2 / 3)


def test_multiclass_equals_spark_ml(spark):
    frame = spark.range(400).select(
        (F.col("id") % 4).cast("double").alias("label"),
        F.pmod(F.col("id") * 13 + F.col("id") % 7, F.lit(5)).cast("double").alias("prediction"),
    )
    found = evaluate.accuracy_f1(frame).head()
    for metric in ("accuracy", "f1"):
        ml = MulticlassClassificationEvaluator(metricName=metric).evaluate(frame)
        assert found[metric] == pytest.approx(ml)
    assert evaluate.confusion(frame).groupBy().sum("n").head()[0] == 400


def test_regression_report(spark):
    data = [(2.5, 3.0), (0.0, -0.5), (2.0, 2.0), (8.0, 7.0)]
    frame = spark.createDataFrame(data, "prediction double, label double")
    found = evaluate.regression_report(frame).head()
    assert tuple(found) == pytest.approx((0.375, 0.612372, 0.948608, 0.5, 8.859375), abs=1e-5)
    for metric, name in (("mse", "mse"), ("r2", "r2"), ("mae", "mae"), ("var", "explained_variance")):
        assert found[name] == pytest.approx(RegressionEvaluator(metricName=metric).evaluate(frame))


def tail(x: float, dof: int) -> float:
    """Closed forms: a finite sum, from exp for even and erfc for odd degrees of freedom."""
    half = x / 2
    start = 0 if dof % 2 == 0 else 0.5
    total = 0.0 if dof % 2 == 0 else math.erfc(math.sqrt(half))
    for k in range(dof // 2):
        a = start + k
        total += math.exp(a * math.log(half) - half - math.lgamma(a + 1))
    return total


def test_chi_square_tail_equals_closed_forms_and_published_quantiles(spark):
    points = [
        (x, dof) for dof in (1, 2, 3, 4, 7, 10, 31, 100, 999, 5000)
        for x in (1e-6, 0.3, 1.0, dof - 0.5, dof + 0.5, dof + 2.5, 1.5 * dof, dof + 60.0, 400.0)
    ]
    rows = spark.createDataFrame(points, "x double, dof bigint")
    found = rows.withColumn("p", chi_square_tail(F.col("x"), F.col("dof"))).collect()
    assert len(found) == len(points)
    for r in found:
        assert r.p == pytest.approx(tail(r.x, r.dof), rel=1e-9, abs=1e-11), r
    # Upper quantiles of printed tables.
    quantiles = [
        (3.841, 1, 0.05), (6.635, 1, 0.01), (5.991, 2, 0.05), (16.812, 6, 0.01),
        (18.307, 10, 0.05), (43.773, 30, 0.05), (124.342, 100, 0.05),
    ]
    table = spark.createDataFrame(quantiles, "x double, dof bigint, p double")
    for r in table.withColumn("q", chi_square_tail(F.col("x"), F.col("dof"))).collect():
        assert r.q == pytest.approx(r.p, abs=2e-5)


def test_chi_square_tail_of_odd_arguments(spark):
    rows = spark.createDataFrame(
        [(0.0, 3), (float("inf"), 3), (5.0, 0), (None, 3), (float("nan"), 3), (1e6, 4), (2.0, None)],
        "x double, dof bigint",
    )
    found = [r.p for r in rows.select(chi_square_tail(F.col("x"), F.col("dof")).alias("p")).collect()]
    assert found == [1.0, 0.0, 1.0, None, None, 0.0, None]


def test_chi_square_p_values_equal_spark_ml(spark):
    rows = [(float(i % 4), float((i * i) % 3), float((i + i // 7) % 2)) for i in range(200)]
    frame = spark.createDataFrame(rows, "a double, b double, label double")
    found = {r.feature: r for r in stats.chi_square_p_values(frame, ["a", "b"], "label").collect()}
    vectors = spark.createDataFrame([(Vectors.dense(a, b), y) for a, b, y in rows], ["f", "y"])
    for name, r in zip("ab", ChiSquareTest.test(vectors, "f", "y", flatten=True).orderBy("featureIndex").collect()):
        assert found[name].dof == r.degreesOfFreedom
        assert found[name].statistic == pytest.approx(r.statistic, abs=1e-9)
        assert found[name].p_value == pytest.approx(r.pValue, abs=1e-9)


def test_ranks_of_few_values_come_back_without_a_shuffle_of_the_rows(spark, plan_text, monkeypatch):
    frame = spark.range(3000).select((F.col("id") % 7).alias("a"), (F.col("id") * 37 % 200).cast("double").alias("b"))
    whole = sorted(map(tuple, stats.correlation.average_ranks(frame, ["a", "b"]).collect()))
    plan = plan_text(stats.correlation.average_ranks(frame, ["a", "b"]))
    assert "hashpartitioning" not in plan and "Join" not in plan.split("(1)")[0]
    for few in (10, 0):  # the second column by a join, then both
        monkeypatch.setattr(stats.correlation, "FEW_VALUES", few)
        assert sorted(map(tuple, stats.correlation.average_ranks(frame, ["a", "b"]).collect())) == whole
