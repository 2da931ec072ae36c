"""Linear models from sums of their rows.

Regression: folds, penalties and errors without another pass.

A least-squares model and its squared error depend on the rows only through their number
and the sums of the values and of their products. Those are added up once per fold. The
training side of a fold is all folds less its own, every point of a penalty grid is
solved on a matrix of features by features, and the error on the fold left out follows
from its own sums.

Logistic regression takes a pass a Newton step, which adds up slopes and curvatures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.plans import persisted

# Most sums in one aggregate, so that its code stays within what the JVM compiles.
SUMS_AT_ONCE = 400


def fold_sums(df: DataFrame, features: Sequence[str], label: str, fold: str) -> DataFrame:
    """Rows (fold, i, j, total): the sums of products of all pairs of values, i <= j.

    Place 0 is the constant one, so (0, 0) counts rows and (0, j) adds up values; then the
    features, then the label. Rows with a null or NaN among them are left out. Sums are
    partial before the shuffle, one row a fold; more than ``SUMS_AT_ONCE`` of them are
    several aggregates. No rows give none.
    """
    names = [*features, label]
    values = [F.col(f"`{n}`").cast("double").alias(f"v{i + 1}") for i, n in enumerate(names)]
    rows = df.select(F.col(f"`{fold}`").alias("fold"), F.lit(1.0).alias("v0"), *values).dropna()
    pairs = [(i, j) for i in range(len(names) + 1) for j in range(i, len(names) + 1)]
    parts = []
    for at in range(0, len(pairs), SUMS_AT_ONCE):
        some = pairs[at : at + SUMS_AT_ONCE]
        sums = rows.groupBy("fold").agg(
            *[F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"s{i}_{j}") for i, j in some]
        )
        cells = F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s{i}_{j}").alias("total"))
                for i, j in some
            ]
        )
        parts.append(sums.select("fold", F.inline(cells)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def matrices(sums: DataFrame, width: int) -> dict[object, np.ndarray]:
    """Fold -> symmetric matrix of its sums; as many numbers as folds times pairs."""
    out: dict[object, np.ndarray] = {}
    for fold, i, j, total in sums.select("fold", "i", "j", "total").toLocalIterator():
        matrix = out.setdefault(fold, np.zeros((width, width)))
        matrix[i, j] = matrix[j, i] = total
    return out


@dataclass(frozen=True)
class LinearModel:
    """prediction = intercept + sum of coefficients times features."""

    features: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float

    def prediction(self) -> Column:
        out = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients, strict=True):
            out = out + F.lit(float(weight)) * F.col(f"`{name}`").cast("double")
        return out

    def squared_error(self, sums: np.ndarray) -> float:
        """Sum of squared errors over the rows that ``sums`` come from."""
        weights = np.concatenate([[-self.intercept], -self.coefficients, [1.0]])
        return max(0.0, float(weights @ sums @ weights))


def solve(
    sums: np.ndarray, features: Sequence[str], penalty: float = 0.0, mix: float = 0.0,
    tolerance: float = 1e-12, rounds: int = 100_000,
) -> LinearModel:
    """Elastic net on standardised features and label, by coordinate descent on the sums.

    Minimises half the mean squared error plus ``penalty`` times ``mix`` of the absolute
    and half of ``1 - mix`` of the squared weights, both in units of standard deviations
    of the features and the penalty in the label's own unit. A constant feature gets
    weight zero; so do all for a constant label or no rows.
    """
    k = len(features)
    n = sums[0, 0]
    weights = np.zeros(k)
    if n == 0:
        return LinearModel(tuple(features), weights, 0.0)
    means = sums[0, 1:] / n
    moments = sums[1:, 1:] / n - np.outer(means, means)
    # What rounding leaves of a constant's variance counts as none.
    square = np.diag(sums)[1:] / n
    variance = np.where(np.diag(moments) > 1e-14 * square, np.diag(moments), 0.0)
    deviation = np.sqrt(variance)
    if deviation[k] > 0:
        scale = np.where(deviation > 0, deviation, np.inf)
        related = moments / np.outer(scale, scale)
        gram, target = related[:k, :k], related[:k, k]
        shrink, ridge = penalty * mix / deviation[k], penalty * (1 - mix) / deviation[k]
        for _ in range(rounds):
            moved = 0.0
            for j in np.flatnonzero(deviation[:k] > 0):
                pull = target[j] - gram[j] @ weights + gram[j, j] * weights[j]
                new = np.sign(pull) * max(abs(pull) - shrink, 0.0) / (gram[j, j] + ridge)
                moved = max(moved, abs(new - weights[j]))
                weights[j] = new
            if moved <= tolerance:
                break
        weights = weights * deviation[k] / scale[:k]
    return LinearModel(tuple(features), weights, float(means[k] - weights @ means[:k]))


def cross_validated(
    by_fold: Mapping[object, np.ndarray], features: Sequence[str],
    grid: Sequence[tuple[float, float]],
) -> tuple[list[tuple], LinearModel]:
    """Rows (penalty, mix, fold, n_train, n_test, rmse) of a grid, and the best point's model.

    The best point has the least mean error over the folds, the first of equals; its model
    is solved on all folds. Folds without other rows to learn from predict zero.
    """
    total = sum(by_fold.values(), np.zeros((len(features) + 2,) * 2))
    board = []
    for penalty, mix in grid:
        for fold, own in sorted(by_fold.items()):
            # Added up and not subtracted, so that nothing cancels.
            others = sum((m for f, m in by_fold.items() if f != fold), np.zeros_like(own))
            error = solve(others, features, penalty, mix).squared_error(own)
            board.append(
                (float(penalty), float(mix), fold, int(others[0, 0]), int(own[0, 0]),
                 float(np.sqrt(error / own[0, 0])))
            )
    means = [
        np.mean([r[5] for r in board if r[:2] == point] or [0.0])
        for point in [(float(p), float(m)) for p, m in grid]
    ]
    penalty, mix = grid[int(np.argmin(means))]
    return board, solve(total, features, penalty, mix)


def fit_logistic(
    df: DataFrame, features: Sequence[str], label: str, penalty: float = 0.0,
    steps: int = 50, tolerance: float = 1e-10,
) -> LinearModel:
    """Ridge logistic regression of a 0/1 label; the model's prediction is the margin.

    Minimises the mean log loss plus half of ``penalty`` times the squared weights in
    units of sample standard deviations. Every pass adds up the loss, its slopes and its
    curvatures; a step that does not lower the loss is halved. Rows with a null or NaN
    are left out. A constant feature gets weight zero; without rows everything is zero,
    and with rows of one class only the intercept is infinite with that class's sign.
    """
    k = len(features)
    values = [F.col(f"`{f}`").cast("double").alias(f"v{i}") for i, f in enumerate(features)]
    rows = df.select(*values, F.col(f"`{label}`").cast("double").alias("y")).dropna()
    with persisted(rows) as held:
        shape = held.agg(
            F.count(F.lit(1)).alias("n"), F.avg("y").alias("share"),
            *[F.avg(f"v{i}").alias(f"m{i}") for i in range(k)],
            *[F.stddev_samp(f"v{i}").alias(f"s{i}") for i in range(k)],
        ).head()
        n, share, weights = shape["n"], shape["share"], np.zeros(k)
        if n == 0:
            return LinearModel(tuple(features), weights, 0.0)
        if share in (0.0, 1.0):
            return LinearModel(tuple(features), weights, float("inf") if share else float("-inf"))
        used = [i for i in range(k) if (shape[f"s{i}"] or 0.0) > 0]
        scaled = held.select("y", F.lit(1.0).alias("z0"), *[
            ((F.col(f"v{i}") - shape[f"m{i}"]) / shape[f"s{i}"]).alias(f"z{at + 1}")
            for at, i in enumerate(used)
        ])
        size = len(used) + 1
        ridge = np.array([0.0] + [penalty] * len(used))
        pairs = [(i, j) for i in range(size) for j in range(i, size)]
        point = last = np.array([np.log(share / (1 - share))] + [0.0] * len(used))
        lowest = np.inf
        for _ in range(steps):
            margin = sum((F.lit(float(w)) * F.col(f"z{i}") for i, w in enumerate(point)), F.lit(0.0))
            chance = 1 / (1 + F.exp(-F.col("m")))
            loss = F.log1p(F.exp(-F.abs("m"))) + F.greatest("m", F.lit(0.0)) - F.col("y") * F.col("m")
            scored = scaled.withColumn("m", margin)
            scored = scored.select("*", loss.alias("loss"), (chance - F.col("y")).alias("e"),
                                   (chance * (1 - chance)).alias("q"))
            sums = scored.agg(
                F.avg("loss").alias("loss"),
                *[F.avg(F.col("e") * F.col(f"z{i}")).alias(f"g{i}") for i in range(size)],
                *[F.avg(F.col("q") * F.col(f"z{i}") * F.col(f"z{j}")).alias(f"h{i}_{j}") for i, j in pairs],
            ).head()
            height = sums["loss"] + 0.5 * float(ridge @ point**2)
            if height > lowest + 1e-12:
                point = (point + last) / 2
                continue
            lowest, last = height, point
            slope = np.array([sums[f"g{i}"] for i in range(size)]) + ridge * point
            bend = np.diag(ridge)
            for i, j in pairs:
                bend[i, j] += sums[f"h{i}_{j}"]
                bend[j, i] = bend[i, j]
            move = np.linalg.lstsq(bend, slope, rcond=None)[0]
            point = point - move
            if np.abs(move).max() <= tolerance:
                break
        for at, i in enumerate(used):
            weights[i] = point[at + 1] / shape[f"s{i}"]
        centre = sum(weights[i] * shape[f"m{i}"] for i in used)
        return LinearModel(tuple(features), weights, float(point[0] - centre))


def coefficient_table(df: DataFrame, model: LinearModel) -> DataFrame:
    """Rows (feature, weight), the intercept under the null feature."""
    rows = [(f, float(w)) for f, w in zip(model.features, model.coefficients, strict=True)]
    return df.sparkSession.createDataFrame(
        [*rows, (None, model.intercept)], "feature string, weight double"
    )
