"""Fitted trees as tables, scores read off them, and grids searched by prefixes.

A tree grown to some depth holds every shallower tree with the same settings: cut at a
depth, each node predicts from its own class counts. A forest holds smaller forests, its
first trees. So one fit a fold and setting stands for all depths and sizes of a grid.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.learning.inspect import last_stage
from tallywood.learning.models import estimator
from tallywood.plans import checkpoint_root, materialized, persisted, scratch_path

# Settings that a deeper tree or a larger forest holds all smaller values of.
PREFIXES = ("maxDepth", "numTrees")


def node_table(model: Model, spark: SparkSession) -> DataFrame:
    """Nodes of a fitted tree, forest or boosted trees, one row a node.

    tree, weight, node (0 is the root; numbered from the top, left before right), feature,
    threshold (numbers up to it go left), categories (those go left), left, right, gain,
    impurity, n (training rows), stats (class counts, or count, sum and sum of squares),
    prediction. What a leaf does not have is null. Read from the saved model, so nothing
    passes through the driver.
    """
    path = scratch_path(spark, "trees")
    last_stage(model).write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" in data.columns:
        # Its columns, number, settings and weight, go by different names over versions.
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "settings", "weight")
        flat = data.select(F.col("treeID").alias("tree"), "nodeData.*").join(
            weights.drop("settings"), "tree"
        )
    else:
        flat = data.select(F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), "*")
    inner = F.col("leftChild") >= 0
    number = F.col("split.numCategories") < 0
    values = F.col("split.leftCategoriesOrThreshold")
    return flat.select(
        "tree", "weight", F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & number, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & ~number, values).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("gain")).alias("gain"),
        "impurity", F.col("rawCount").alias("n"), F.col("impurityStats").alias("stats"), "prediction",
    )


def _packed(nodes: DataFrame) -> Column:
    """All trees as one array of arrays of nodes: a value of the size of the model."""
    columns = ["node", "tree", "feature", "threshold", "categories", "left", "right", "stats", "prediction", "weight"]
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("nodes"))
    ordered = F.sort_array(F.collect_list(F.struct("tree", "nodes")))
    return trees.agg(ordered.alias("trees")).select(F.col("trees.nodes").alias("trees")).scalar()


def _path(nodes: Column, values: Column, depth: int) -> Column:
    """Numbers of the nodes that a row passes in one tree, from the root down."""

    def further(path: Column, _: Column) -> Column:
        at = F.get(nodes, F.element_at(path, -1))
        value = F.get(values, at["feature"])
        left = F.coalesce(value <= at["threshold"], F.array_contains(at["categories"], value))
        after = F.when(left, at["left"]).otherwise(at["right"])
        return F.when(at["left"].isNull(), path).otherwise(F.concat(path, F.array(after)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(F.lit(0)), further)


def walked(rows: DataFrame, nodes: DataFrame, features: str, depth: int) -> DataFrame:
    """Rows with ``trees`` and ``paths``: the way each row takes through each tree."""
    held = rows.withColumn("trees", _packed(nodes)).withColumn("_x", vector_to_array(features))
    paths = F.transform("trees", lambda tree: _path(tree, F.col("_x"), depth))
    return held.withColumn("paths", paths).drop("_x")


def _reached(tree: Column, path: Column, depth: int | None) -> Column:
    """Node where a row ends in a tree cut at a depth."""
    last = F.size(path) - 1
    return F.get(tree, F.get(path, last if depth is None else F.least(last, F.lit(depth))))


def _class_shares(node: Column) -> Column:
    total = F.aggregate(node["stats"], F.lit(0.0), lambda a, b: a + b)
    return F.transform(node["stats"], lambda x: F.when(total > 0, x / total).otherwise(0.0))


def _likeliest(votes: Column) -> Column:
    return (F.array_position(votes, F.array_max(votes)) - 1).cast("double")


def _votes(shares: Column, size: int | None) -> Column:
    """Class shares added up over the first trees, in their order."""
    some = shares if size is None else F.slice(shares, 1, size)
    none = F.transform(F.get(shares, F.lit(0)), lambda _: F.lit(0.0))
    return F.aggregate(some, none, lambda a, b: F.zip_with(a, b, lambda x, y: x + y))


def score_classes(
    rows: DataFrame, nodes: DataFrame, features: str = "features", depth: int = 30, name: str = "prediction"
) -> DataFrame:
    """Rows with the class that the trees of ``nodes`` vote for, as column expressions."""
    shares = F.zip_with("trees", "paths", lambda t, p: _class_shares(_reached(t, p, None)))
    way = walked(rows, nodes, features, depth).withColumn("_shares", shares)
    return way.withColumn(name, _likeliest(_votes(F.col("_shares"), None))).drop("trees", "paths", "_shares")


def score_values(
    rows: DataFrame, nodes: DataFrame, features: str = "features", depth: int = 30,
    mean: bool = True, name: str = "prediction",
) -> DataFrame:
    """Rows with the mean (or, of boosted trees, the weighted sum) of the trees' values."""
    def value(t: Column, p: Column) -> Column:
        node = _reached(t, p, None)
        return node["prediction"] * (F.lit(1.0) if mean else node["weight"])

    way = walked(rows, nodes, features, depth)
    total = F.aggregate(F.zip_with("trees", "paths", value), F.lit(0.0), lambda a, b: a + b)
    found = total / F.size("paths") if mean else total
    return way.withColumn(name, found).drop("trees", "paths")


def prefix_predictions(
    rows: DataFrame, nodes: DataFrame, features: str, depths: Sequence[int], sizes: Sequence[int]
) -> DataFrame:
    """Rows with ``found``: an array of (depth, size, prediction) for every cut of the trees:
    the vote of the first ``size`` trees, each cut at ``depth``."""

    def shares(depth: int) -> Column:
        return F.zip_with("trees", "paths", lambda t, p: _class_shares(_reached(t, p, depth)))

    way = walked(rows, nodes, features, max(depths))
    way = way.withColumns({f"_shares{d}": shares(d) for d in depths})
    points = [
        F.struct(
            F.lit(d).alias("depth"), F.lit(s).alias("size"),
            _likeliest(_votes(F.col(f"_shares{d}"), s)).alias("prediction"),
        )
        for d in depths for s in sizes
    ]
    return way.select(*rows.columns, F.array(*points).alias("found"))


def single_predictions(
    rows: DataFrame, nodes: DataFrame, features: str, depths: Sequence[int]
) -> DataFrame:
    """Rows with ``found``: an array of (tree, depth, prediction) of every tree by itself."""
    way = walked(rows, nodes, features, max(depths))

    def cut(depth: int) -> Column:
        return F.zip_with("trees", "paths", lambda t, p: F.struct(
            F.get(t, F.lit(0))["tree"].alias("tree"), F.lit(depth).alias("depth"),
            _likeliest(_class_shares(_reached(t, p, depth))).alias("prediction"),
        ))

    return way.select(*rows.columns, F.concat(*[cut(d) for d in depths]).alias("found"))


def area_of_outcomes(true_pos: int, false_pos: int, true_neg: int, false_neg: int) -> float:
    """Area under the ROC curve of hard 0/1 predictions; a class without rows counts as told right."""
    hit = true_pos / (true_pos + false_neg) if true_pos + false_neg else 1.0
    false = false_pos / (false_pos + true_neg) if false_pos + true_neg else 0.0
    return (1 + hit - false) / 2


def _settings(grid: Mapping[str, Sequence]) -> Iterator[dict]:
    names = [n for n in grid if n not in PREFIXES]
    for values in product(*(grid[n] for n in names)):
        yield dict(zip(names, values))


def prefix_grid(
    rows: DataFrame, kind: str, grid: Mapping[str, Sequence], fold: Column, folds: int,
    features: str = "features", label: str = "label", parallelism: int = 8,
) -> DataFrame:
    """Board of a whole grid by k-fold cross validation of 0/1 classes, best first.

    ``kind``: ``tree`` or ``forest``. ``fold`` numbers the rows' folds from 0. One fit a fold
    and combination of the settings other than depth and number of trees, at the greatest
    of those; all their values are evaluated in one pass over the held-out fold, from the
    table of nodes. Trees of one fold are scored together. The metric is the area under
    the ROC curve of the predictions, the mean over folds.

    Depths are exact: a tree cut at a depth predicts as the tree grown to it. A smaller
    forest is the first trees of the larger one; fitted alone it would draw other rows,
    and cut at a depth other features, so its metric differs as by another seed.
    """
    depths, sizes = sorted(grid["maxDepth"]), sorted(grid.get("numTrees", [1]))
    most = {"maxDepth": max(depths)} | ({"numTrees": max(sizes)} if "numTrees" in grid else {})
    settings = list(_settings(grid))
    spark = rows.sparkSession
    checkpoint_root(spark)
    held = materialized(rows.select(features, label, fold.cast("int").alias("_fold")), "folds")
    with persisted(held) as known, ThreadPool(parallelism) as pool:
        known.count()

        def fitted(task: tuple[int, int]) -> DataFrame:
            number, at = task
            model = estimator(kind, features=features, label=label, **settings[at], **most)
            return node_table(model.fit(known.where(F.col("_fold") != number)), spark)

        def outcomes(task: tuple[DataFrame, DataFrame, list]) -> list[tuple]:
            own, nodes, keys = task
            if kind == "tree":
                found = single_predictions(own, nodes, features, depths)
                point = ("p.tree", "p.depth")
            else:
                found = prefix_predictions(own, nodes, features, depths, sizes)
                point = ("p.size", "p.depth")
            hit = F.col("p.prediction") == 1
            counts = found.select(label, F.explode("found").alias("p")).groupBy(*point).agg(
                F.count_if(hit & (F.col(label) == 1)), F.count_if(hit & (F.col(label) != 1)),
                F.count_if(~hit & (F.col(label) != 1)), F.count_if(~hit & (F.col(label) == 1)),
            )
            areas = [(r[0], r[1], area_of_outcomes(*r[2:])) for r in counts.collect()]
            if kind == "tree":
                return [(at, depth, 1, area) for at, depth, area in areas]
            return [(keys[0], depth, size, area) for size, depth, area in areas]

        tasks = list(product(range(folds), range(len(settings))))
        tables = dict(zip(tasks, pool.map(fitted, tasks, chunksize=1)))
        scored = []
        for number in range(folds):
            own = known.where(F.col("_fold") == number)
            each = [tables[number, at].withColumn("tree", F.lit(at) if kind == "tree" else F.col("tree"))
                    for at in range(len(settings))]
            if kind == "tree":
                scored.append((own, reduce(DataFrame.unionAll, each), []))
            else:
                scored += [(own, nodes, [at]) for at, nodes in enumerate(each)]
        done = pool.map(outcomes, scored, chunksize=1)
    areas: dict[tuple, list[float]] = {}
    for at, depth, size, area in (row for rows in done for row in rows):
        areas.setdefault((at, depth, size), []).append(area)
    board = []
    for (at, depth, size), values in areas.items():
        shown = settings[at] | {"maxDepth": depth} | ({"numTrees": size} if "numTrees" in grid else {})
        text = ", ".join(f"{n}={v}" for n, v in sorted(shown.items()))
        board.append((text, sum(values) / len(values)))
    board.sort(key=lambda r: (-r[1], r[0]))
    placed = [(i + 1, text, area) for i, (text, area) in enumerate(board)]
    return spark.createDataFrame(placed, "place int, params string, metric double")
