from __future__ import annotations

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tallywood.learning import trees
from tallywood.learning.models import estimator


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers x0 and x1 and a category x2; label 1 where they meet a rule, with noise."""
    base = spark.range(400).select(
        "id", ((F.col("id") * 37) % 101).cast("double").alias("x0"),
        ((F.col("id") * 53) % 17).cast("double").alias("x1"), ((F.col("id") * 7) % 5).cast("double").alias("x2"),
    )
    rule = (F.col("x0") > 40) & (F.col("x1") < 12) | (F.col("x2") == 3)
    noisy = F.when(F.col("id") % 11 == 0, ~rule).otherwise(rule)
    known = base.withColumn("label", noisy.cast("double")).withColumn("value", 3 * F.col("x0") - F.col("x1") * F.col("x2"))
    coded = known.withColumn("x2", F.col("x2").alias("x2", metadata={
        "ml_attr": {"type": "nominal", "name": "x2", "vals": list("abcde")}
    }))
    return VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(coded).cache()


def test_nodes_of_a_tree(spark, rows):
    model = estimator("tree", maxDepth=4).fit(rows)
    nodes = {r.node: r for r in trees.node_table(model, spark).collect()}
    assert len(nodes) == model.numNodes and nodes[0].n == 400
    for r in nodes.values():
        assert (r.left is None) == (r.right is None) == (r.feature is None) == (r.gain is None)
        if r.left is not None:
            assert (r.threshold is None) != (r.categories is None)
            assert [a + b for a, b in zip(nodes[r.left].stats, nodes[r.right].stats)] == r.stats
            assert nodes[r.left].n + nodes[r.right].n == r.n
        assert r.prediction == r.stats.index(max(r.stats))
    assert any(r.categories for r in nodes.values())


@pytest.mark.parametrize("kind,settings", [
    ("tree", {"maxDepth": 12}), ("forest", {"maxDepth": 8, "numTrees": 7}), ("tree", {"maxDepth": 0}),
])
def test_table_scores_as_the_classifier(spark, rows, kind, settings):
    model = estimator(kind, **settings).fit(rows)
    told = model.transform(rows).withColumnRenamed("prediction", "told")
    found = trees.score_classes(told, trees.node_table(model, spark), depth=12)
    assert found.where("told != prediction OR prediction IS NULL").count() == 0
    assert found.select("prediction").distinct().count() == (1 if settings["maxDepth"] == 0 else 2)


def test_table_scores_as_the_regressors(spark, rows):
    forest = estimator("forest_regression", label="value", numTrees=4, maxDepth=6).fit(rows)
    boosted = GBTRegressor(labelCol="value", maxIter=4, maxDepth=3, seed=1).fit(rows)
    for model, mean in ((forest, True), (boosted, False)):
        told = model.transform(rows).withColumnRenamed("prediction", "told")
        found = trees.score_values(told, trees.node_table(model, spark), mean=mean)
        assert found.where("abs(told - prediction) > 1e-9 OR prediction IS NULL").count() == 0


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_cut_trees_are_the_shallower_trees(spark, rows, impurity):
    depths = [0, 1, 2, 3, 5, 9]
    whole = estimator("tree", maxDepth=14, impurity=impurity, maxBins=9).fit(rows)
    nodes = trees.node_table(whole, spark)
    cut = trees.single_predictions(rows, nodes, "features", depths)
    for i, depth in enumerate(depths):
        alone = estimator("tree", maxDepth=depth, impurity=impurity, maxBins=9).fit(rows)
        told = alone.transform(cut)
        assert told.where(F.col("found")[i]["prediction"] != F.col("prediction")).count() == 0
    forest = trees.prefix_predictions(rows, nodes, "features", depths, [1]).select("id", "found.prediction")
    single = cut.select("id", F.col("found.prediction").alias("p"))
    assert forest.join(single, "id").where("prediction != p").count() == 0


def test_first_trees_of_a_forest_vote(spark, rows):
    model = estimator("forest", maxDepth=3, numTrees=6).fit(rows)
    nodes = trees.node_table(model, spark)
    found = trees.prefix_predictions(rows, nodes, "features", [2, 3], [2, 6])
    told = model.transform(found)
    whole = F.filter("found", lambda p: (p["depth"] == 3) & (p["size"] == 6))[0]["prediction"]
    assert told.where(whole != F.col("prediction")).count() == 0
    two = trees.score_classes(rows, nodes.where("tree < 2"), depth=3).select("id", "prediction")
    part = F.filter("found", lambda p: (p["depth"] == 3) & (p["size"] == 2))[0]["prediction"]
    assert found.select("id", part.alias("p")).join(two, "id").where("p != prediction").count() == 0


def test_grids_by_prefixes(spark, rows):
    fold = F.pmod("id", F.lit(3))
    board = trees.prefix_grid(rows, "tree", {"impurity": ["gini", "entropy"], "maxDepth": [1, 4], "maxBins": [8]}, fold, 3)
    found = {r.params: r.metric for r in board.collect()}
    assert [r.place for r in board.orderBy("place").collect()] == [1, 2, 3, 4]
    assert sorted(found.values(), reverse=True) == [r.metric for r in board.orderBy("place").collect()]
    for depth in (1, 4):
        areas = []
        for f in range(3):
            model = estimator("tree", impurity="entropy", maxDepth=depth, maxBins=8).fit(rows.where(fold != f))
            told = model.transform(rows.where(fold == f)).groupBy("label", "prediction").count().collect()
            n = {(r.label, r.prediction): r["count"] for r in told}
            outcome = n.get((1, 1), 0), n.get((0, 1), 0), n.get((0, 0), 0), n.get((1, 0), 0)
            areas.append(trees.area_of_outcomes(*outcome))
        assert found[f"impurity=entropy, maxBins=8, maxDepth={depth}"] == pytest.approx(sum(areas) / 3, abs=1e-12)
    forests = trees.prefix_grid(
        rows, "forest", {"maxDepth": [2, 3], "numTrees": [2, 5], "featureSubsetStrategy": ["all"]}, fold, 3
    )
    assert forests.count() == 4 and forests.where("metric BETWEEN 0 AND 1").count() == 4


def test_area_of_hard_predictions():
    assert trees.area_of_outcomes(30, 10, 40, 20) == pytest.approx(0.7)
    assert trees.area_of_outcomes(5, 0, 0, 0) == 1.0 and trees.area_of_outcomes(0, 3, 0, 0) == 0.5
