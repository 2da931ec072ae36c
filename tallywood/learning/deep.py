"""Deep classification trees from counted cells: work by rows, not by nodes times bins.

Features are binned once. Rows of equal bins and label are one cell with a count; a tree
needs no more of them. Nodes with many cells are split level by level over the cluster,
by sums per (node, feature, bin, class). The cells of every smaller node then go to one
task, which grows all below it. Cells that are only asked for go the same way and note
the class shares where each point of a grid would stop: a tree cut at a depth, or at the
first gain under a limit, is the tree grown with that setting.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.learning.trees import area_of_outcomes
from tallywood.plans import materialized, shipped

# Cells of a node that one task grows; nodes with more are split over the cluster.
TASK_CELLS = 200_000
# Class counts of category subsets that are held at a time.
SUBSETS_AT_ONCE = 2_000_000
# The label of rows that are only asked for, and the fold of those to be predicted.
ASKED, TO_PREDICT = -1, -2


@dataclass(frozen=True)
class Tree:
    """One tree to grow: its bins, and the fold it does not learn from but is asked for.

    ``draws``: rows are drawn with replacement and ``subset`` features tried at each node.
    """

    number: int
    bins: int
    impurity: str
    left_out: int
    seed: int = 0
    draws: bool = False
    subset: int = 0


@dataclass(frozen=True)
class Shape:
    """Classes, categories of each feature (0: a number), and the points of a grid:
    (greatest depth, least gain)."""

    classes: int
    categories: tuple[int, ...]
    points: tuple[tuple[int, float], ...]


def thresholds(rows: DataFrame, columns: Sequence[str], bins: Sequence[int]) -> dict[int, dict[str, list[float]]]:
    """Candidate splits of numbers by number of bins: half way between all values, or
    quantiles where there are more values than bins."""
    most = max(bins)
    values = {}
    for c in columns:
        some = rows.select(F.col(c).cast("double").alias(c)).dropna().distinct().limit(most + 1)
        values[c] = sorted(r[0] for r in some.collect())
    shares = sorted({i / b for b in bins for i in range(1, b)})
    many = [c for c in columns if len(values[c]) > min(bins)]
    found = rows.select(*[F.col(c).cast("double") for c in many]).approxQuantile(many, shares, 0.1 / most) if many else []
    at = {c: dict(zip(shares, own)) for c, own in zip(many, found)}

    def own(c: str, b: int) -> list[float]:
        if len(values[c]) <= b:
            return [(low + high) / 2 for low, high in zip(values[c], values[c][1:])]
        return sorted({at[c][i / b] for i in range(1, b)})

    return {b: {c: own(c, b) for c in columns} for b in bins}


def binned(rows: DataFrame, cuts: Mapping[str, Sequence[float]], categories: Sequence[str], name: str) -> DataFrame:
    """Rows with ``name``: bins of the numbers, then the categories' own numbers.

    What is missing has a bin of its own, the last.
    """
    inner = {c: list(own) or [0.0] for c, own in cuts.items()}
    tool = Bucketizer(
        splitsArray=[[float("-inf"), *own, float("inf")] for own in inner.values()],
        inputCols=[f"_n{i}" for i in range(len(inner))],
        outputCols=[f"_b{i}" for i in range(len(inner))], handleInvalid="keep",
    )
    held = rows.withColumns({f"_n{i}": F.col(c).cast("double") for i, c in enumerate(inner)})
    placed = [F.coalesce(F.col(f"_b{i}").cast("int"), F.lit(len(own) + 1)) for i, own in enumerate(inner.values())]
    bins = F.array(*placed, *[F.col(c).cast("int") for c in categories])
    return tool.transform(held).select(*rows.columns, bins.alias(name))


def cells(rows: DataFrame, bins: int, x: str, label: str, fold: str) -> DataFrame:
    """(bins, x, y, fold, n): rows of equal bins, label and fold as one."""
    y = F.coalesce(F.col(label).cast("int"), F.lit(ASKED)).alias("y")
    keys = [F.lit(bins).alias("bins"), F.col(x).alias("x"), y, F.col(fold).cast("int").alias("fold")]
    return rows.select(*keys).groupBy("bins", "x", "y", "fold").agg(F.count(F.lit(1)).alias("n"))


# --- splits ------------------------------------------------------------------------


def _impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    total = counts.sum(axis=-1, keepdims=True)
    shares = counts / np.where(total > 0, total, 1)
    if kind == "gini":
        return 1 - (shares * shares).sum(axis=-1)
    return -(shares * np.log2(np.where(shares > 0, shares, 1))).sum(axis=-1)


def _gains(left: np.ndarray, whole: np.ndarray, own: np.ndarray, kind: str) -> np.ndarray:
    """What splits win over their node; -inf where a side is empty."""
    right = whole - left
    n, a = whole.sum(axis=-1), left.sum(axis=-1)
    gain = own - a / n * _impurity(left, kind) - (n - a) / n * _impurity(right, kind)
    return np.where((a > 0) & (a < n), gain, -np.inf)


def _number_splits(node, value, y, w, whole, own, kind) -> tuple[np.ndarray, np.ndarray]:
    """Per node the best gain of a split by a number, and the last bin on its left."""
    gain, cut = np.full(len(whole), -np.inf), np.zeros(len(whole), np.int64)
    width = int(value.max()) + 1
    key = node * width + value
    order = np.argsort(key, kind="stable")
    key = key[order]
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    weights = np.zeros((len(key), whole.shape[1]))
    weights[np.arange(len(key)), y[order]] = w[order]
    through = np.cumsum(weights, axis=0)[last]
    at = key[last] // width
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    before = np.zeros_like(through[first])
    before[1:] = through[first[1:] - 1]
    place = np.cumsum(np.append(False, at[1:] != at[:-1]))
    found = _gains(through - before[place], whole[at], own[at], kind)
    best = np.maximum.reduceat(found, first)
    hits = np.flatnonzero(found == best[place])
    _, pick = np.unique(place[hits], return_index=True)
    gain[at[first]], cut[at[first]] = best, key[last][hits[pick]] % width
    return gain, cut


def _category_splits(node, value, y, w, whole, own, kind, size, subsets) -> tuple[np.ndarray, np.ndarray]:
    """Per node the best gain of a split by a category, and the bits of those on its left.

    ``subsets``: all of them are tried; else those along the order of the categories'
    shares (of two classes, where this is the same) or impurities.
    """
    k, classes = whole.shape
    table = np.bincount((node * size + value) * classes + y, w, k * size * classes).reshape(k, size, classes)
    gain, bits = np.full(k, -np.inf), np.zeros(k, np.int64)
    if subsets:
        chosen = np.arange(1, 2 ** (size - 1))
        member = (chosen[:, None] >> np.arange(size)) & 1
        step = max(1, SUBSETS_AT_ONCE // (len(chosen) * classes))
        for a in range(0, k, step):
            left = np.einsum("sv,kvc->ksc", member.astype(float), table[a : a + step])
            found = _gains(left, whole[a : a + step, None], own[a : a + step, None], kind)
            best = found.argmax(axis=1)
            gain[a : a + step], bits[a : a + step] = found[np.arange(len(best)), best], chosen[best]
        return gain, bits
    n = table.sum(axis=2)
    level = table[..., 1] / np.where(n > 0, n, 1) if classes == 2 else _impurity(table, kind)
    order = np.argsort(np.where(n > 0, level, np.inf), axis=1, kind="stable")
    left = np.cumsum(np.take_along_axis(table, order[..., None], axis=1), axis=1)
    found = _gains(left, whole[:, None], own[:, None], kind)
    best = found.argmax(axis=1)
    through = np.cumsum(np.left_shift(1, order), axis=1)
    rows = np.arange(k)
    return found[rows, best], through[rows, best]


def _tried(path: np.ndarray, tree: Tree, width: int) -> np.ndarray:
    """Which features each node tries: as many as the tree says, by a hash of its path."""
    if not tree.subset or tree.subset >= width:
        return np.ones((len(path), width), bool)
    with np.errstate(over="ignore"):
        h = path.astype(np.uint64)[:, None] * np.uint64(64) + np.arange(width, dtype=np.uint64)
        h += np.uint64(tree.seed * 1_000_003 + tree.number) * np.uint64(0x9E3779B97F4A7C15)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    return np.argsort(np.argsort(h ^ (h >> np.uint64(31)), axis=1), axis=1) < tree.subset


def _best(columns, path, whole, tree: Tree, shape: Shape, many: int) -> tuple[np.ndarray, ...]:
    """Best gain, feature and cut (or bits) per node; of equal gains the first.

    ``columns`` has (node, value, y, w) for each feature; ``many`` is the number of bins.
    """
    own = _impurity(whole, tree.impurity)
    tried = _tried(path, tree, len(shape.categories))
    gain, feature, cut = np.full(len(whole), -np.inf), np.zeros(len(whole), np.int64), np.zeros(len(whole), np.int64)
    for f, (node, value, y, w) in enumerate(columns):
        if not len(node):
            continue
        size = shape.categories[f]
        if size:
            subsets = shape.classes > 2 and 2 ** (size - 1) - 1 <= many // 2
            found, at = _category_splits(node, value, y, w, whole, own, tree.impurity, size, subsets)
        else:
            found, at = _number_splits(node, value, y, w, whole, own, tree.impurity)
        better = (found > gain) & tried[:, f]
        gain[better], feature[better], cut[better] = found[better], f, at[better]
    return gain, feature, cut


def _open_after(open_: np.ndarray, gain: np.ndarray, depth: int, shape: Shape) -> np.ndarray:
    """Bits of the points whose tree splits a node of this gain, in each node."""
    left = np.zeros_like(open_)
    for i, (deepest, least) in enumerate(shape.points):
        if depth < deepest:
            left |= np.where((gain > 1e-12) & (gain >= least), open_ & (1 << i), 0)
    return left


def _shares(whole: np.ndarray) -> np.ndarray:
    total = whole.sum(axis=1, keepdims=True)
    return whole / np.where(total > 0, total, 1)


def _note(found: np.ndarray, shares: np.ndarray, open_: np.ndarray) -> None:
    """Write the shares of their node into the open points of asked rows."""
    for i in range(found.shape[1]):
        some = (open_ >> i) & 1 == 1
        found[some, i] = shares[some]


def _goes_right(values: np.ndarray, cut: np.ndarray, category: np.ndarray) -> np.ndarray:
    by_category = (cut >> np.where(category, values, 0)) & 1 == 0
    return np.where(category, by_category, values > cut)


def _grow(path: int, open_: int, x, y, w, asked, found, tree: Tree, shape: Shape, many: int) -> None:
    """Grow all below one node, all nodes of a level together; fills ``found`` (asked, point, class)."""
    categorical = np.array(shape.categories) > 0
    paths, opens = np.array([path]), np.array([open_])
    depth = int(path).bit_length() - 1
    node, held, mine = np.zeros(len(y), np.int64), np.zeros(len(asked), np.int64), np.arange(len(asked))
    while len(paths):
        whole = np.bincount(node * shape.classes + y, w, len(paths) * shape.classes).reshape(-1, shape.classes)
        now = found[mine]
        _note(now, _shares(whole)[held], opens[held])
        found[mine] = now
        columns = [(node, x[:, f], y, w) for f in range(x.shape[1])]
        gain, feature, cut = _best(columns, paths, whole, tree, shape, many)
        opens = _open_after(opens, gain, depth, shape)
        splits = opens > 0
        child = np.cumsum(splits) - 1
        keep, keep_asked = splits[node], splits[held]
        node, x, y, w = node[keep], x[keep], y[keep], w[keep]
        held, mine, asked = held[keep_asked], mine[keep_asked], asked[keep_asked]
        right = _goes_right(x[np.arange(len(node)), feature[node]], cut[node], categorical[feature[node]])
        right_asked = _goes_right(asked[np.arange(len(held)), feature[held]], cut[held], categorical[feature[held]])
        node, held = 2 * child[node] + right, 2 * child[held] + right_asked
        paths, opens = np.repeat(paths[splits] * 2, 2) + np.tile([0, 1], splits.sum()), np.repeat(opens[splits], 2)
        depth += 1


# --- cells on their way --------------------------------------------------------------

WAY = "tree int, node bigint, open bigint, cell bigint, x array<int>, y int, w double, asked boolean, found array<double>"


def _drawn(n: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """How often cells of n rows are drawn, row by row with replacement: Poisson(n)."""
    out, uniform = np.zeros(len(n)), (seeds.view(np.uint64) >> np.uint64(11)) / 2.0**53
    few = n <= 200
    chance, k = np.exp(-n[few].astype(float)), 0
    through, left = chance.copy(), uniform[few]
    while (more := left > through).any() and k < 1000:
        k += 1
        chance = chance * n[few] / k
        through += chance
        out[np.flatnonzero(few)[more]] = k
    for i in np.flatnonzero(~few):
        out[i] = np.random.default_rng(int(seeds[i]) & (2**63 - 1)).poisson(n[i])
    return out


def _matrix(column: pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _numbers(table, name: str) -> np.ndarray:
    return table.column(name).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table[name].to_numpy()


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    width = values.shape[1]
    offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), kind))


def _started(held: DataFrame, trees: Sequence[Tree], shape: Shape) -> DataFrame:
    """Every cell with every tree that learns from it or is asked for it."""
    spark = held.sparkSession
    known = spark.createDataFrame(
        [(t.number, t.bins, t.left_out, t.seed, t.draws) for t in trees],
        "tree int, bins int, left_out int, seed int, draws boolean",
    )
    asked = F.col("fold") == F.col("left_out")
    none = F.array_repeat(F.lit(0.0), len(shape.points) * shape.classes)
    met = held.join(F.broadcast(known), "bins").where(asked | (F.col("y") != ASKED)).select(
        "tree", F.lit(1).cast("bigint").alias("node"),
        F.lit((1 << len(shape.points)) - 1).cast("bigint").alias("open"), "cell", "x", "y",
        F.col("n").cast("double").alias("w"), asked.alias("asked"),
        F.when(asked, none).otherwise(F.array().cast("array<double>")).alias("found"),
        F.when(F.col("draws") & ~asked, F.xxhash64("x", "y", "fold", "tree", "seed")).alias("draw"),
    )
    if not any(t.draws for t in trees):
        return met.drop("draw")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column("draw").is_valid().to_numpy(zero_copy_only=False)
            w = _numbers(batch, "w").copy()
            if some.any():
                seeds = batch.column("draw").filter(pa.array(some)).to_numpy().astype(np.int64)
                w[some] = _drawn(w[some], seeds)
            at = batch.schema.get_field_index("w")
            out = batch.set_column(at, "w", pa.array(w)).drop_columns(["draw"])
            yield out.filter(pa.array((w > 0) | ~some))

    return met.mapInArrow(draw, WAY)


def _split_large(way: DataFrame, large: DataFrame, known: dict, shape: Shape, many: dict) -> dict:
    """(tree, node) -> (gain, feature, cut, class counts) of nodes that no task takes whole."""

    def choose(table: pa.Table) -> pa.Table:
        number, path = table["tree"][0].as_py(), table["node"][0].as_py()
        tree = known[number]
        f, value, y, w = (table[c].to_numpy() for c in ("f", "value", "y", "w"))
        own = f == 0
        whole = np.bincount(y[own], w[own], shape.classes)[None]
        columns = [(np.zeros((f == i).sum(), np.int64), value[f == i].astype(np.int64), y[f == i], w[f == i])
                   for i in range(len(shape.categories))]
        gain, feature, cut = _best(columns, np.array([path]), whole, tree, shape, many[tree.bins])
        return pa.table({
            "tree": pa.array([number], pa.int32()), "node": pa.array([path], pa.int64()),
            "gain": pa.array(gain), "feature": pa.array(feature), "cut": pa.array(cut),
            "whole": _lists(whole, pa.float64()),
        })

    sums = (
        way.where("NOT asked").join(F.broadcast(large), ["tree", "node"])
        .select("tree", "node", "y", "w", F.posexplode("x").alias("f", "value"))
        .groupBy("tree", "node", "f", "value", "y").agg(F.sum("w").alias("w"))
    )
    schema = "tree int, node bigint, gain double, feature bigint, cut bigint, whole array<double>"
    rows = sums.groupBy("tree", "node").applyInArrow(choose, schema).collect()
    return {(r["tree"], r["node"]): (r["gain"], r["feature"], r["cut"], r["whole"]) for r in rows}


def _descended(way: DataFrame, splits: dict, shape: Shape) -> DataFrame:
    """Cells of split nodes one level further down; node 0 for asked cells that are through."""
    categorical = np.array(shape.categories) > 0
    width, points, classes = len(shape.categories), len(shape.points), shape.classes

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, node, open_ = (_numbers(batch, c).copy() for c in ("tree", "node", "open"))
            asked = _numbers(batch, "asked").astype(bool)
            x = _matrix(batch.column("x"), width, np.int64)
            found = _matrix(batch.column("found"), points * classes, float).reshape(-1, points, classes)
            at_found = np.cumsum(asked) - 1
            for number, path in {*zip(tree.tolist(), node.tolist())} & splits.keys():
                gain, feature, cut, whole = splits[number, path]
                some = np.flatnonzero((tree == number) & (node == path))
                own = some[asked[some]]
                now = found[at_found[own]]
                _note(now, np.repeat(_shares(np.array([whole])), len(own), axis=0), open_[own])
                found[at_found[own]] = now
                left = _open_after(open_[some], np.full(len(some), gain), path.bit_length() - 1, shape)
                right = _goes_right(x[some, feature], np.full(len(some), cut), np.full(len(some), categorical[feature]))
                open_[some], node[some] = left, np.where(left > 0, 2 * path + right, 0)
            sizes = np.where(asked, points * classes, 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(found.ravel())
            )
            for name, column in (("node", pa.array(node)), ("open", pa.array(open_)), ("found", lists)):
                batch = batch.set_column(batch.schema.get_field_index(name), name, column)
            yield batch.filter(pa.array(asked | (node > 0)))

    return way.mapInArrow(down, WAY)


def grown(
    counted: DataFrame, trees: Sequence[Tree], shape: Shape, many: Mapping[int, int], limit: int = TASK_CELLS
) -> tuple[DataFrame, DataFrame]:
    """Grow ``trees`` from ``cells``; the asked cells' class shares.

    ``many``: number of bins by ``Tree.bins``. Returns the numbered cells, and (tree, cell,
    found): for each cell of the fold that a tree leaves out the shares of all classes, point
    after point. No task gets more than ``limit`` cells of a node, unless they are all equal.
    """
    spark = counted.sparkSession
    shipped(spark)
    held = materialized(counted.withColumn("cell", F.monotonically_increasing_id()), "cells")
    known, most = {t.number: t for t in trees}, dict(many)
    width, points, classes = len(shape.categories), len(shape.points), shape.classes
    way = materialized(_started(held, trees, shape), "way")
    while True:
        sizes = way.where("node > 0").groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("asked")).alias("k"))
        large = sizes.where((F.col("n") > limit) & (F.col("k") > 0)).select("tree", "node").collect()
        if not large:
            break
        nodes = spark.createDataFrame([(r[0], r[1]) for r in large], "tree int, node bigint")
        splits = _split_large(way, nodes, known, shape, most)
        way = materialized(_descended(way, splits, shape), "way")

    def finish(table: pa.Table) -> pa.Table:
        number, path, open_ = (table[c][0].as_py() for c in ("tree", "node", "open"))
        asked = table["asked"].to_numpy().astype(bool)
        own, rest = table.filter(pa.array(asked)), table.filter(pa.array(~asked))
        found = _matrix(own["found"], points * classes, float).reshape(-1, points, classes).copy()
        if path and rest.num_rows and own.num_rows:
            _grow(path, open_, _matrix(rest["x"], width, np.int64), rest["y"].to_numpy().astype(np.int64),
                  rest["w"].to_numpy(), _matrix(own["x"], width, np.int64), found,
                  known[number], shape, most[known[number].bins])
        return pa.table({
            "tree": own["tree"].cast(pa.int32()), "cell": own["cell"],
            "found": _lists(found.reshape(len(found), points * classes), pa.float64()),
        })

    total = way.count()
    parts = max(4 * spark.sparkContext.defaultParallelism, len(trees), -(-4 * total // limit))
    # Asked cells that are through are spread by themselves.
    spread = F.when(F.col("node") == 0, F.pmod("cell", F.lit(parts))).otherwise(0).alias("spread")
    open_way = way.select("*", spread).repartition(parts, "tree", "node", "spread")
    done = open_way.groupBy("tree", "node", "spread").applyInArrow(finish, "tree int, cell bigint, found array<double>")
    return held, materialized(done, "found")


def point_shares(found: str, point: int, classes: int) -> Column:
    """Class shares of one point of a grid."""
    return F.slice(found, point * classes + 1, classes)


def likeliest(shares: Column) -> Column:
    return (F.array_position(shares, F.array_max(shares)) - 1).cast("double")


# --- grids ---------------------------------------------------------------------------


def _all_cells(
    rows: DataFrame, numbers: Sequence[str], categories: Sequence[str], label: str, fold: str, bins: Sequence[int]
) -> tuple[DataFrame, dict[int, DataFrame]]:
    """Cells for every number of bins, and the rows with their bins ``x``.

    Candidate splits come from the rows that are learned from, of all folds.
    """
    cuts = thresholds(rows.where(F.col(fold) != TO_PREDICT), numbers, bins)
    placed = {b: binned(rows, cuts[b], categories, "x") for b in bins}
    return reduce(DataFrame.unionAll, [cells(placed[b], b, "x", label, fold) for b in bins]), placed


def fold_grid(
    rows: DataFrame, numbers: Sequence[str], label: str, fold: Column, folds: int, grid: Mapping[str, Sequence]
) -> DataFrame:
    """Board of a tree's grid (impurity, maxBins, maxDepth) by k-fold cross validation, best first.

    One tree a fold, impurity and number of bins holds all depths. The metric is the area
    under the ROC curve of the predictions of 0/1 classes, the mean over folds.
    """
    held = rows.select(*numbers, label, fold.cast("int").alias("_fold"))
    settings = list(product(grid["impurity"], grid["maxBins"]))
    depths = list(grid["maxDepth"])
    grown_trees = [
        Tree(at * folds + f, bins, impurity, f) for at, (impurity, bins) in enumerate(settings) for f in range(folds)
    ]
    shape = Shape(2, (0,) * len(numbers), tuple((d, 0.0) for d in depths))
    counted, _ = _all_cells(held, numbers, [], label, "_fold", grid["maxBins"])
    known, found = grown(counted, grown_trees, shape, {b: b for b in grid["maxBins"]})
    hits = F.array(*[likeliest(point_shares("found", i, 2)) for i in range(len(depths))])
    told = found.select("tree", "cell", F.posexplode(hits).alias("point", "told")).join(known.select("cell", "y", "n"), "cell")
    hit, true, n = F.col("told") == 1, F.col("y") == 1, F.col("n")
    counts = told.groupBy("tree", "point").agg(
        *[F.sum(F.when(c, n).otherwise(0)) for c in (hit & true, hit & ~true, ~hit & ~true, ~hit & true)]
    )
    areas: dict[tuple, list[float]] = {}
    for tree, point, *outcomes in counts.orderBy("tree", "point").collect():
        areas.setdefault((tree // folds, point), []).append(area_of_outcomes(*outcomes))
    board = []
    for (at, point), values in areas.items():
        shown = {"impurity": settings[at][0], "maxBins": settings[at][1], "maxDepth": depths[point]}
        text = ", ".join(f"{n}={v}" for n, v in sorted(shown.items()))
        board.append((text, sum(values) / len(values)))
    board.sort(key=lambda r: (-r[1], r[0]))
    placed = [(i + 1, text, area) for i, (text, area) in enumerate(board)]
    return rows.sparkSession.createDataFrame(placed, "place int, params string, metric double")


def _forest(at: int, size: int, bins: int, impurity: str, left_out: int, width: int, seed: int) -> list[Tree]:
    """A tree that sees all rows and features, or ``size`` trees that draw both."""
    if size == 1:
        return [Tree(at, bins, impurity, left_out)]
    some = int(np.ceil(np.sqrt(width)))
    return [Tree(at + i, bins, impurity, left_out, seed, True, some) for i in range(size)]


def _votes(found: DataFrame, groups: Sequence[Sequence[int]], size: int) -> DataFrame:
    """(cell, v0, v1, ...): class shares added up over each group of trees; null if it has none."""
    def own(trees: Sequence[int], i: int) -> Column:
        return F.sum(F.when(F.col("tree").isin(*trees), F.col("found")[i]))

    return found.groupBy("cell").agg(*[
        F.when(F.count_if(F.col("tree").isin(*trees)) > 0, F.array(*[own(trees, i) for i in range(size)])).alias(f"v{g}")
        for g, trees in enumerate(groups)
    ])


def validated_predictions(
    rows: DataFrame, numbers: Sequence[str], categories: Mapping[str, int], label: str, classes: int,
    fold: str, grid: Mapping[str, Sequence], seed: int = 0,
) -> DataFrame:
    """The rows of the fold ``TO_PREDICT`` with ``prediction``, by the best point of a grid.

    ``grid``: impurity, maxBins, maxDepth, minInfoGain and numTrees. Points learn from the
    rows of fold 1 and are compared by their accuracy on fold 0; the first of the best learns
    again from both. ``categories`` gives the number of each one's categories. One tree
    stands for all depths and gains, and the first trees of a forest for a smaller one.
    """
    bins, sizes = list(grid["maxBins"]), list(grid["numTrees"])
    points = list(product(grid["maxDepth"], grid["minInfoGain"]))
    settings = list(product(grid["impurity"], bins, sorted({min(s, 2) for s in sizes})))
    counted, placed = _all_cells(rows, numbers, [*categories], label, fold, bins)
    counted = materialized(counted, "counted-cells")
    kinds, width = (*(0 for _ in numbers), *categories.values()), len(numbers) + len(categories)
    shape = Shape(classes, kinds, tuple(points))
    each = max(sizes)
    trees = {
        (impurity, b, least): _forest(at * each, 1 if least == 1 else each, b, impurity, 0, width, seed)
        for at, (impurity, b, least) in enumerate(settings)
    }
    groups = [(impurity, b, s) for impurity, b, s in product(grid["impurity"], bins, sizes)]
    numbers_of = [[t.number for t in trees[i, b, min(s, 2)][:s]] for i, b, s in groups]
    many = {b: b for b in bins}
    known, found = grown(counted, [t for own in trees.values() for t in own], shape, many)
    votes = _votes(found, numbers_of, len(points) * classes).join(known.select("cell", "y", "n"), "cell")
    told = {(g, p): likeliest(point_shares(f"v{g}", p, classes)) for g in range(len(groups)) for p in range(len(points))}
    n = F.col("n")
    right = votes.agg(*[
        (F.sum(F.when(t == F.col("y"), n).otherwise(0)) / F.sum(F.when(t.isNotNull(), n))).alias(f"a{g}_{p}")
        for (g, p), t in told.items()
    ]).head()
    accuracy = {k: right[f"a{k[0]}_{k[1]}"] or 0.0 for k in told}
    (impurity, b, size), point = max(
        ((groups[g], points[p]) for g, p in told), key=lambda k: accuracy[groups.index(k[0]), points.index(k[1])]
    )
    best = _forest(0, size, b, impurity, TO_PREDICT, width, seed)
    known, found = grown(counted.where(F.col("bins") == b), best, Shape(classes, kinds, (point,)), many)
    shown = likeliest(F.col("v0")).alias("prediction")
    answers = _votes(found, [[t.number for t in best]], classes).select("cell", shown)
    by_bins = known.where(F.col("fold") == TO_PREDICT).join(answers, "cell").select("x", "prediction")
    return placed[b].where(F.col(fold) == TO_PREDICT).join(by_bins, "x").drop("x")
