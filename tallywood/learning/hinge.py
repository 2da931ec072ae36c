"""Linear support vector machines: all folds and points of a grid in shared scans.

The hinge has a corner, where Newton's and gradient steps fail; rounded off within a
width it has slopes and curvatures, and its least point costs at most half the width
more. The width falls from scan to scan until that is below the tolerance. Every scan
meets each row with all models that still move, and shuffles only their sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.learning.linear import LinearModel
from tallywood.learning.trees import area_of_outcomes
from tallywood.plans import persisted, shipped

# The first width of the rounded corner, and what it falls by.
WIDEST, NARROWER = 2.0, 4.0
# The least that curvatures are raised by; they are zero where no row is in the corner.
LEAST_RAISED = 1e-9
WHOLE = -1


class _Search:
    """One model on its way: its point, the next one to look at, and the width of the corner."""

    def __init__(self, left_out: int, penalty: float, mean: np.ndarray, deviation: np.ndarray):
        size = len(mean) + 1
        self.left_out, self.mean, self.deviation = left_out, mean, deviation
        self.ridge = np.array([0.0] + [penalty] * len(mean))
        self.point = self.trial = np.zeros(size)
        self.width, self.lowest, self.done = WIDEST, np.inf, False
        # Slope and curvature at the point, and what the curvature is raised by.
        self.slope, self.curve, self.raised = np.zeros(size), np.eye(size), LEAST_RAISED

    def take(self, n: float, loss: float, slope: np.ndarray, bend: np.ndarray, tolerance: float) -> None:
        """Go on from what a scan added up at the trial point."""
        if not n:
            self.done = True
            return
        height = loss / n + 0.5 * float(self.ridge @ self.trial**2)
        if height <= self.lowest:
            self.point, self.lowest, self.raised = self.trial, height, max(self.raised / 10, LEAST_RAISED)
            self.slope, self.curve = slope / n + self.ridge * self.point, bend / n + np.diag(self.ridge)
        else:
            self.raised *= 10
        move = self._move()
        # A step of more than a unit leaves where the curvature was measured.
        while np.abs(move).max() > 1:
            self.raised *= 10
            move = self._move()
        if float(self.slope @ move) <= tolerance / 100:
            self.trial = self.point
            self._narrow(tolerance)
        else:
            self.trial = self.point - move

    def _move(self) -> np.ndarray:
        return np.linalg.solve(self.curve + self.raised * np.eye(len(self.slope)), self.slope)

    def _narrow(self, tolerance: float) -> None:
        """The same point once more, at the next width."""
        if self.width <= tolerance:
            self.done = True
        self.width, self.lowest = max(self.width / NARROWER, tolerance), np.inf

    def model(self, features: Sequence[str]) -> LinearModel:
        weights = np.where(self.deviation > 0, self.point[1:] / np.where(self.deviation > 0, self.deviation, 1), 0.0)
        return LinearModel(tuple(features), weights, float(self.point[0] - weights @ self.mean))


def _sums(held: DataFrame, moving: dict[int, _Search], k: int) -> dict[int, np.ndarray]:
    """(n, rounded loss, its slopes, its curvatures) of every model at its trial point."""
    size = k + 1
    upper = np.triu_indices(size)
    total = 2 + size + len(upper[0])
    asked = {i: (s.left_out, s.mean, s.deviation, s.trial, s.width) for i, s in moving.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {i: np.zeros(total) for i in asked}
        for batch in batches:
            columns = [batch.column(j).to_numpy(zero_copy_only=False) for j in range(k + 2)]
            x, side, fold = np.column_stack(columns[:k]), 2 * columns[k] - 1, columns[k + 1]
            for i, (left_out, mean, deviation, point, width) in asked.items():
                own = fold != left_out
                z = np.ones((own.sum(), size))
                z[:, 1:] = np.where(deviation > 0, (x[own] - mean) / np.where(deviation > 0, deviation, 1), 0)
                y = side[own]
                short = 1 - y * (z @ point)
                near = (short > 0) & (short < width)
                loss = np.where(near, short * short / (2 * width), np.where(short > 0, short - width / 2, 0))
                pull = -y * np.clip(short / width, 0, 1)
                bend = (z[near].T @ z[near]) / width
                sums[i] += np.concatenate([[len(z), loss.sum()], pull @ z, bend[upper]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))],
            ["model", "sums"],
        )

    parts = held.mapInArrow(run, "model int, sums array<double>")
    added = parts.groupBy("model").agg(F.array(*[F.sum(F.col("sums")[j]) for j in range(total)]).alias("sums"))
    return {r["model"]: np.array(r["sums"]) for r in added.collect()}


def _moments(held: DataFrame, k: int, folds: Sequence[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Means and sample deviations of the rows that each fold leaves."""
    shown = [f(F.col(f"v{i}")).alias(f"{n}{i}") for i in range(k) for n, f in (("m", F.avg), ("s", F.stddev_samp))]
    out = {}
    for left_out in folds:
        row = held.where(F.col("fold") != left_out).agg(*shown).head()
        out[left_out] = tuple(np.array([row[f"{n}{i}"] or 0.0 for i in range(k)]) for n in "ms")
    return out


def fit_all(
    held: DataFrame, features: Sequence[str], models: Sequence[tuple[int, float]], tolerance: float, scans: int
) -> list[LinearModel]:
    """A model for every (fold left out, or ``WHOLE``; penalty), in at most ``scans`` scans.

    ``held`` has v0, v1, ..., y (0 or 1) and fold. Minimises the mean hinge loss plus half of
    the penalty times the squared weights in units of sample deviations.
    """
    k = len(features)
    shipped(held.sparkSession)
    shapes = _moments(held, k, sorted({f for f, _ in models}))
    searches = [_Search(f, penalty, *shapes[f]) for f, penalty in models]
    for _ in range(scans):
        moving = {i: s for i, s in enumerate(searches) if not s.done}
        if not moving:
            break
        found = _sums(held, moving, k)
        size, upper = k + 1, np.triu_indices(k + 1)
        for i, search in moving.items():
            sums = found.get(i, np.zeros(2 + size + len(upper[0])))
            bend = np.zeros((size, size))
            bend[upper] = sums[2 + size :]
            bend = bend + bend.T - np.diag(np.diag(bend))
            search.take(sums[0], sums[1], sums[2 : 2 + size], bend, tolerance)
    return [s.model(features) for s in searches]


def cross_validated(
    df: DataFrame, features: Sequence[str], label: str, fold: Column, folds: int,
    grid: Mapping[str, Sequence],
) -> tuple[list[tuple], LinearModel]:
    """Rows (penalty, area) of a grid (regParam, one maxIter and tol), and the best point's model.

    The area is that under the ROC curve of the predictions, the mean over the folds; the
    first of equals is the best. Rows with a null or NaN are left out.
    """
    values = [F.col(f"`{f}`").cast("double").alias(f"v{i}") for i, f in enumerate(features)]
    rows = df.select(*values, F.col(f"`{label}`").cast("double").alias("y"), fold.cast("int").alias("fold")).dropna()
    (tolerance,), (scans,), penalties = grid["tol"], grid["maxIter"], list(grid["regParam"])
    models = [(f, p) for p in penalties for f in [*range(folds), WHOLE]]
    with persisted(rows) as held:
        fitted = dict(zip(models, fit_all(held, [f"v{i}" for i in range(len(features))], models, tolerance, scans)))
        board = []
        for p in penalties:
            margin = F.lit(float("nan"))
            for f in range(folds):
                margin = F.when(F.col("fold") == f, fitted[f, p].prediction()).otherwise(margin)
            hit, true = F.col("margin") > 0, F.col("y") == 1
            counts = held.withColumn("margin", margin).groupBy("fold").agg(
                *[F.count_if(c) for c in (hit & true, hit & ~true, ~hit & ~true, ~hit & true)]
            )
            areas = [area_of_outcomes(*r[1:]) for r in counts.collect()]
            board.append((float(p), float(np.mean(areas)) if areas else 0.0))
    best = max(range(len(board)), key=lambda i: board[i][1])
    found = fitted[WHOLE, penalties[best]]
    return board, LinearModel(tuple(features), found.coefficients, found.intercept)
