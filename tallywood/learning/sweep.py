"""K-means for many numbers of clusters at once: one scan of the rows an iteration.

Every scan meets each row with the centers of all numbers of clusters that still move,
adds rows up per (k, cluster) within its task, and shuffles only those sums. So a sweep
takes as many scans as its slowest member, not the scans of all members together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.plans import shipped

# Rows whose distances to the centers of one k are held at a time.
ROWS_AT_ONCE = 2048
# Clusters whose tasks' sums are added up in one partition.
CLUSTERS_A_PART = 512


@dataclass(frozen=True)
class Clustering:
    """Centers for one number of clusters, and the steps they took to settle."""

    centers: np.ndarray
    steps: int
    settled: bool


def _nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest center and squared distance; the smaller number of equals."""
    apart = np.zeros((len(points), len(centers)))
    for j in range(points.shape[1]):
        apart += (points[:, j, None] - centers[None, :, j]) ** 2
    nearest = apart.argmin(axis=1)
    return nearest, apart[np.arange(len(points)), nearest]


def _points(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The first ``width`` columns of a batch, some rows at a time."""
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        some = batch.slice(at, ROWS_AT_ONCE)
        yield np.column_stack([some.column(i).to_numpy(zero_copy_only=False) for i in range(width)])


def finite_rows(df: DataFrame, columns: Sequence[str], *more: Column) -> DataFrame:
    """The columns as finite numbers v0, v1, ...; rows with another value are left out."""
    values = [F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
    rows = df.select(*values, *more)
    for i in range(len(columns)):
        rows = rows.where(f"v{i} > double('-infinity') AND v{i} < double('infinity')")
    return rows


def task_sums(
    frame: DataFrame, centers: dict[int, np.ndarray], width: int,
    add: Callable[[Iterator[pa.RecordBatch], dict[int, np.ndarray]], None],
) -> DataFrame:
    """Rows (k, cluster, n, cost, s0, s1, ...) from what ``add`` adds up in each task.

    ``add`` gets a task's batches and an array (n, cost, s0, ...) by cluster for every k; a
    task hands on one row per non-empty cluster.
    """
    names = [f"s{j}" for j in range(width)]
    schema = "k int, cluster int, n bigint, cost double, " + ", ".join(f"{n} double" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: np.zeros((len(c), 2 + width)) for k, c in centers.items()}
        add(batches, held)
        for k, sums in held.items():
            some = np.flatnonzero(sums[:, 0])
            if len(some):
                arrays = [
                    pa.array(np.full(len(some), k), pa.int32()), pa.array(some, pa.int32()),
                    pa.array(sums[some, 0].astype(np.int64)),
                    *[pa.array(sums[some, place]) for place in range(1, 2 + width)],
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["k", "cluster", "n", "cost", *names])

    shipped(frame.sparkSession)
    # One row per task and cluster is shuffled: few partitions do, and the many of a session's default take longer.
    parts = -(-sum(len(c) for c in centers.values()) // CLUSTERS_A_PART) or 1
    return frame.mapInArrow(run, schema).repartition(parts, "k", "cluster").groupBy("k", "cluster").agg(
        *[F.sum(c).alias(c) for c in ["n", "cost", *names]]
    )


def cluster_sums(
    df: DataFrame, columns: Sequence[str], centers: dict[int, np.ndarray]
) -> DataFrame:
    """Rows (k, cluster, n, cost, s0, s1, ...) of the non-empty clusters of every k.

    One scan, whatever the number of k; a task hands on one row per cluster.
    """
    width = len(columns)

    def add(batches: Iterator[pa.RecordBatch], held: dict[int, np.ndarray]) -> None:
        for batch in batches:
            for points in _points(batch, width):
                for k, own in centers.items():
                    nearest, apart = _nearest(points, own)
                    for place, values in enumerate([None, apart, *points.T]):
                        held[k][:, place] += np.bincount(nearest, values, len(own))

    return task_sums(finite_rows(df, columns), centers, width, add)


def moved_until_settled(
    sums: Callable[[dict[int, np.ndarray]], DataFrame],
    centers: dict[int, np.ndarray], iterations: int, tolerance: float,
) -> dict[int, Clustering]:
    """Lloyd's steps from the given centers of every k, with ``sums`` of the rows."""
    centers = dict(centers)
    steps, moving = dict.fromkeys(centers, 0), {k for k, c in centers.items() if len(c)}
    while moving and max(steps[k] for k in moving) < iterations:
        new = {k: centers[k].copy() for k in moving}
        for row in sums({k: centers[k] for k in moving}).collect():
            new[row["k"]][row["cluster"]] = np.array(row[4:]) / row["n"]
        for k in sorted(moving):
            steps[k] += 1
            far = ((new[k] - centers[k]) ** 2).sum(axis=1).max()
            centers[k] = new[k]
            if far <= tolerance**2:
                moving.discard(k)
    return {k: Clustering(centers[k], steps[k], k not in moving) for k in centers}


def fit_all(
    df: DataFrame, columns: Sequence[str], ks: Sequence[int], place: Column,
    iterations: int = 40, tolerance: float = 1e-5,
) -> dict[int, Clustering]:
    """Lloyd's steps for all ``ks`` together, from the first rows by ``place``.

    A k starts from its first k rows (all, if there are fewer) and stops when no center
    moves further than ``tolerance``; an empty cluster keeps its center. Rows with a null,
    NaN or infinite value take no part; without rows there are no centers. Only centers
    and their sums reach the driver: as many numbers as clusters times columns.
    """
    if not ks or min(ks) < 1:
        raise ValueError("numbers of clusters are 1 or more")
    first = finite_rows(df, columns, place.alias("place")).orderBy("place", *[f"v{i}" for i in range(len(columns))])
    start = [list(r)[:-1] for r in first.limit(max(ks)).collect()]
    start = np.array(start, dtype=float).reshape(len(start), len(columns))
    centers = {k: start[:k].copy() for k in ks}
    return moved_until_settled(lambda some: cluster_sums(df, columns, some), centers, iterations, tolerance)


def assigned(df: DataFrame, columns: Sequence[str], fitted: dict[int, Clustering], keep: str) -> DataFrame:
    """Rows (keep, k, cluster) for every row and k, by one scan; count them before shuffling."""
    width = len(columns)
    ks = sorted(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for points in _points(batch, width):
                found = np.column_stack([_nearest(points, fitted[k].centers)[0] for k in ks])
                offsets = np.arange(len(points) + 1) * len(ks)
                clusters = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(found.ravel(), pa.int32())
                )
                kept = batch.column(width).slice(at, len(points))
                at += len(points)
                yield pa.RecordBatch.from_arrays([kept, clusters], ["keep", "clusters"])

    rows = finite_rows(df, columns, F.col(f"`{keep}`").alias("keep"))
    kind = rows.schema["keep"].dataType.simpleString()
    found = rows.mapInArrow(run, f"keep {kind}, clusters array<int>")
    numbers = F.array(*[F.lit(k) for k in ks])
    each = found.select(F.col("keep").alias(keep), F.posexplode("clusters").alias("_place", "cluster"))
    return each.select(keep, F.get(numbers, F.col("_place")).alias("k"), "cluster")


def costs(df: DataFrame, columns: Sequence[str], fitted: dict[int, Clustering]) -> DataFrame:
    """Rows (k, n_clusters, cost): non-empty clusters and summed squared distance."""
    sums = cluster_sums(df, columns, {k: f.centers for k, f in fitted.items() if len(f.centers)})
    return sums.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_clusters"), F.sum("cost").alias("cost")
    )


def label_entropies(
    df: DataFrame, columns: Sequence[str], fitted: dict[int, Clustering], label: str
) -> DataFrame:
    """Rows (k, entropy): the labels' entropy within clusters, weighted by their size."""
    counts = assigned(df, columns, {k: f for k, f in fitted.items() if len(f.centers)}, label)
    counts = counts.groupBy("k", "cluster", label).agg(F.count(F.lit(1)).cast("double").alias("n"))
    sizes = counts.groupBy("k", "cluster").agg(
        F.sum("n").alias("size"), F.sum(F.col("n") * F.log("n")).alias("inner")
    )
    spread = F.col("size") * F.log("size") - F.col("inner")
    return sizes.groupBy("k").agg((F.sum(spread) / F.sum("size")).alias("entropy"))
