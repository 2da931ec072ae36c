"""Clusters of integer vectors around centroids, searched by Walsh-Hadamard coefficients.

The transform multiplies a vector by a matrix of 1 and -1 whose rows are orthogonal, so
64 times the squared distance of two vectors of 64 components is the sum of the squared
differences of their coefficients. Taken from coarse coefficients (few sign changes) to
fine ones, every partial sum is a lower bound of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.plans.scratch import materialized

WIDTH = 64
# Coefficients summed up when worse centroids go; after the last, sums are whole.
LEVELS = (4, 8, 16, 32, 64)
# Integers up to this size keep all sums within 64 bits; greater ones, up to the second
# bound, are summed as Python integers, and beyond it a distance is no long.
SMALL, GREATEST = 1 << 21, 1 << 27
ROWS_AT_ONCE = 2048


def sequency(width: int = WIDTH) -> np.ndarray:
    """Rows of the transform's matrix from the fewest sign changes to the most."""
    signs = transform(np.eye(width, dtype=np.int64))
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def transform(vectors: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, by sums and differences of halves."""
    out = vectors.copy()
    rows, width = out.shape
    half = 1
    while half < width:
        pairs = out.reshape(rows, width // (2 * half), 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([low + high, low - high], axis=2).reshape(rows, width)
        half *= 2
    return out


def _exact(values: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if max(np.abs(values).max(initial=0), np.abs(other).max(initial=0)) > SMALL:
        return values.astype(object), other.astype(object)
    return values, other


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of, and exact squared distance to, the nearest centroid; ties: the smaller number.

    After each level every centroid goes whose partial sum is strictly greater than the
    whole distance to one that looked nearest so far; those left sum up all coefficients.
    """
    if not len(vectors):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    x, c = _exact(vectors, centroids)
    order = sequency(x.shape[1])
    x, c = transform(x)[:, order], transform(c)[:, order]
    first = LEVELS[0]
    partial = ((x[:, None, :first] - c[None, :, :first]) ** 2).sum(axis=2)
    guess = partial.argmin(axis=1)
    bound = ((x - c[guess]) ** 2).sum(axis=1)
    row, number = np.nonzero((partial <= bound[:, None]).astype(bool))
    part = partial[row, number]
    for start, end in zip(LEVELS, LEVELS[1:]):
        part = part + ((x[row, start:end] - c[number, start:end]) ** 2).sum(axis=1)
        left = (part <= bound[row]).astype(bool)
        row, number, part = row[left], number[left], part[left]
    # Rows and, within them, centroids are still in order, and each row has one at least.
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    least = np.minimum.reduceat(part, starts)
    hit = np.flatnonzero((part == least[row]).astype(bool))
    hit = hit[np.concatenate([[True], row[hit][1:] != row[hit][:-1]])]
    return number[hit], (least // x.shape[1]).astype(np.int64)


def kept(df: DataFrame, vector: str = "embedding", width: int = WIDTH) -> Column:
    """True for vectors of ``width`` components, none of them null or not finite."""
    wrong = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.coalesce((F.size(vector) == width) & ~wrong, F.lit(False))


def _floored(flat: np.ndarray, scale: int) -> np.ndarray:
    values = np.floor(scale * flat)
    if np.abs(values).max(initial=0) > GREATEST:
        raise OverflowError(f"a component times {scale} is over {GREATEST}: no exact distance")
    return values.astype(np.int64)


def _integers(column: pa.ListArray, scale: int, width: int) -> np.ndarray:
    flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return _floored(flat, scale).reshape(-1, width)


def _blocks(batch: pa.RecordBatch, scale: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield at, _integers(batch.column("vector").slice(at, ROWS_AT_ONCE), scale, width)


def _sums(rows: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """Rows and sums of each component by nearest centroid, one row a task and centroid."""
    k, width = centroids.shape
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(k, dtype=np.int64)
        sums = np.zeros((k, width), dtype=np.int64)
        for batch in batches:
            for _, values in _blocks(batch, scale, width):
                number, _ = nearest(values, centroids)
                counts += np.bincount(number, minlength=k)
                order = np.argsort(number, kind="stable")
                some, starts = np.unique(number[order], return_index=True)
                if len(some):
                    sums[some] += np.add.reduceat(values[order], starts)
        some = np.flatnonzero(counts)
        if len(some):
            columns = [some, counts[some], *(sums[some, i] for i in range(width))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["c", "n", *names])

    schema = ", ".join(f"{c} bigint" for c in ["c", "n", *names])
    parts = rows.select("vector").mapInArrow(run, schema)
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ["n", *names]]
    return parts.groupBy("c").agg(*whole)


def starting_centroids(rows: DataFrame, k: int, seed: str, scale: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes; ties by the vector itself."""
    first = (
        rows.where("vec_id IS NOT NULL")
        .select(F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256).alias("h"), "vector")
        .orderBy("h", "vector")
        .limit(k)
        .collect()
    )
    return _floored(np.array([r["vector"] for r in first], dtype=np.float64), scale)


def refine(rows: DataFrame, centroids: np.ndarray, rounds: int, scale: int) -> np.ndarray:
    """Centroids after some rounds of assigning all vectors and taking floored means."""
    for _ in range(rounds):
        centroids = centroids.copy()
        for row in _sums(rows, centroids, scale).collect():
            number, count, *sums = (int(v) for v in row)
            centroids[number] = [s // count for s in sums]
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector; one pass, nothing is shuffled."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for at, values in _blocks(batch, scale, width):
                number, distance = nearest(values, centroids)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(values)), pa.array(number, pa.int32()), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    return rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    seed: str = "2:",
    scale: int = 256,
    digest: Callable[[np.ndarray], str] | None = None,
) -> DataFrame:
    """Cluster of every vector of ``vectors`` (vec_id, embedding), with sums of distances.

    Vectors of other than 64 components, or with a null or non-finite one, are left out;
    the rest become integers ``floor(scale * x)``. Centroids start as the ``k`` vectors
    with the smallest SHA-256 of ``seed`` and vec_id (all, if there are fewer). Each round
    assigns all vectors (ties: the smaller number) and replaces centroids that have some
    by their floored mean. What reaches the driver is k centroids and their sums; every
    pass reads the table anew, so a lost executor costs its tasks only.

    A row with a null vec_id is assigned and counted and is no starting centroid; if all
    ids are null there are no rows. Repeated rows count, and come out, as often as they
    are there. Other columns are ignored. No vectors: no rows. Components over 2**27 /
    scale, whose distances are no longs, raise OverflowError.
    """
    digest = digest or (lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
    rows = vectors.where(kept(vectors)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector")
    )
    start = starting_centroids(rows, k, seed, scale)
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    if not len(start):
        none = vectors.sparkSession.createDataFrame([], "vec_id bigint, distance bigint, " + schema)
        return none.select(*columns)
    centroids = refine(rows, start, rounds, scale)
    assigned = materialized(assign(rows, centroids, scale), "assigned")
    totals = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    inertia = sum(t["s"] for t in totals)
    # One row a centroid: small whatever the table.
    about = vectors.sparkSession.createDataFrame(
        [(t["cluster"], t["s"], inertia, digest(centroids[t["cluster"]])) for t in totals], schema
    )
    return assigned.join(F.broadcast(about), "cluster").select(*columns)


def cluster_sql(k: int = 40, rounds: int = 5, seed: str = "2:", scale: int = 256) -> str:
    """The same over the table ``embeddings`` in DuckDB, by all distances."""
    steps = [
        f"""v AS MATERIALIZED (
          SELECT row_number() OVER () AS r, vec_id,
            list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS x
          FROM embeddings
          WHERE len(embedding) = {WIDTH}
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""",
        f"""c0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY sha256('{seed}' || vec_id), x) - 1 AS c, x
          FROM v WHERE vec_id IS NOT NULL ORDER BY c LIMIT {k}
        )""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
              SELECT r, min(struct_pack(d := d, c := c)) AS best FROM (
                SELECT r, c, CAST(list_dot_product(v.x, v.x) + list_dot_product(c{i}.x, c{i}.x)
                  - 2 * list_dot_product(v.x, c{i}.x) AS BIGINT) AS d FROM v, c{i}
              ) GROUP BY r
            )"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS (
                  SELECT c, list(mean ORDER BY i) AS x FROM (
                    SELECT best.c AS c, i, floor(sum(x[i]) / count(*)) AS mean
                    FROM a{i} JOIN v USING (r), range(1, {WIDTH + 1}) t(i) GROUP BY ALL
                  ) GROUP BY c
                ),
                c{i + 1} AS MATERIALIZED (
                  SELECT c, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} USING (c)
                )"""
            )
    return f"""WITH {", ".join(steps)}
      SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
        CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
        CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(list_transform(e.x, lambda y: CAST(y AS BIGINT)), ','))
          AS centroid_sha256
      FROM a{rounds} JOIN v USING (r) JOIN c{rounds} e ON e.c = best.c
    """
