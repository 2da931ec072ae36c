"""Approximate nearest neighbours over learned partitions of a neighbour graph."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywood.plans.scratch import materialized

# Vectors that partitions and classifier are learnt from: the bound of what the driver holds.
SAMPLE_ROWS = 10_000
# Rows that a partition should have, and most partitions.
PARTITION_ROWS = 1500
MOST_PARTITIONS = 256
# Edges from each sampled vector in the neighbour graph.
GRAPH_EDGES = 10
# Share of the true neighbours that the probed partitions must hold, on the sample.
AIM = 0.95
# Rows and queries that one task compares at a time.
BLOCK_ROWS = 4096


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, and one of them not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _nearest(vectors: np.ndarray, others: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Indices of the k largest inner products of each vector, in no order."""
    found = np.empty((len(vectors), k), dtype=np.int64)
    for at in range(0, len(vectors), 512):
        sims = vectors[at : at + 512] @ others.T
        if own:
            sims[np.arange(len(sims)), np.arange(at, at + len(sims))] = -np.inf
        found[at : at + 512] = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return found


def _halves(vectors: np.ndarray, parts: int) -> np.ndarray:
    """A balanced start: split along the widest direction in proportion, again and again."""
    labels = np.zeros(len(vectors), dtype=np.int64)
    waiting = [(np.arange(len(vectors)), 0, parts)]
    while waiting:
        rows, first, n = waiting.pop()
        if n == 1:
            labels[rows] = first
            continue
        own = vectors[rows] - vectors[rows].mean(axis=0)
        _, axes = np.linalg.eigh(own.T @ own)
        order = np.argsort(own @ axes[:, -1], kind="stable")
        left = n // 2
        cut = len(rows) * left // n
        waiting.append((rows[order[:cut]], first, left))
        waiting.append((rows[order[cut:]], first + left, n - left))
    return labels


def balanced_partition(
    edges: np.ndarray, labels: np.ndarray, parts: int, slack: float = 0.05, passes: int = 8
) -> np.ndarray:
    """Move vertices to where most of their neighbours are, as far as there is room.

    ``edges``: neighbours of each vertex, taken in both directions. No part gets more
    than its even share and ``slack``; vertices that gain most move first.
    """
    n, k = edges.shape
    labels = labels.copy()
    room = int(np.ceil((1 + slack) * n / parts))
    a = np.concatenate([np.repeat(np.arange(n), k), edges.ravel()])
    b = np.concatenate([edges.ravel(), np.repeat(np.arange(n), k)])
    for turn in range(passes):
        votes = np.zeros((n, parts), dtype=np.int32)
        np.add.at(votes, (a, labels[b]), 1)
        wish = votes.argmax(axis=1)
        gain = votes[np.arange(n), wish] - votes[np.arange(n), labels]
        sizes = np.bincount(labels, minlength=parts)
        moved = 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            # Every other one waits, so that pairs do not swap places for ever.
            if sizes[wish[v]] < room and (v + turn) % 2 == 0:
                sizes[labels[v]] -= 1
                sizes[wish[v]] += 1
                labels[v] = wish[v]
                moved += 1
        if not moved and turn % 2:
            break
    return labels


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer: the probability of each partition."""

    centre: np.ndarray
    scale: float
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        hidden = np.maximum((vectors - self.centre) * self.scale @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias


def train_router(
    vectors: np.ndarray, labels: np.ndarray, parts: int, hidden: int = 128,
    epochs: int = 5, batch: int = 256, rate: float = 2e-3, seed: int = 5,
) -> Router:
    """Fit by Adam on the cross entropy of the partitions."""
    rng = np.random.default_rng(seed)
    dims = vectors.shape[1]
    centre = vectors.mean(axis=0)
    scale = 1.0 / max(float((vectors - centre).std()), 1e-12)
    x = (vectors - centre) * scale
    weights = [
        rng.normal(0, np.sqrt(2 / dims), (dims, hidden)), np.zeros(hidden),
        rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts),
    ]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            h = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            z = h @ weights[2] + weights[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p /= len(rows)
            back = (p @ weights[2].T) * (h > 0)
            slopes = [x[rows].T @ back, back.sum(axis=0), h.T @ p, p.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Router(centre, scale, *weights)


def _ranked(logits: np.ndarray) -> np.ndarray:
    return np.argsort(-logits, axis=1, kind="stable")


def fit(sample: np.ndarray, parts: int, k: int) -> tuple[Router, int]:
    """The router for ``parts`` partitions, and how many of them a query must probe.

    Probes: the fewest whose rows hold AIM of the k nearest neighbours in the sample, for
    a tenth of its vectors that the router was not trained on.
    """
    if parts == 1:
        return train_router(sample, np.zeros(len(sample), np.int64), 1, epochs=0), 1
    edges = _nearest(sample, sample, min(GRAPH_EDGES, len(sample) - 1), own=True)
    labels = balanced_partition(edges, _halves(sample, parts), parts)
    asked = max(len(sample) // 10, 1)
    router = train_router(sample[asked:], labels[asked:], parts)
    ranked = _ranked(router.logits(sample))
    near = _nearest(sample[:asked], sample, min(k, len(sample) - 1), own=True)
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.arange(parts)[None, :].repeat(len(ranked), axis=0), axis=1)
    needed = place[np.arange(asked)[:, None], ranked[near, 0]]
    share = np.bincount(needed.ravel(), minlength=parts).cumsum() / needed.size
    return router, int(np.searchsorted(share, AIM) + 1)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, components added in their order."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def best_of_block(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
    floors: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of each query's k nearest other rows, ties to smaller ids.

    Only rows with a score of at least the query's floor: it has k others that good.

    A matrix product finds who may be among them; the scores are then computed one by
    one, so that equal vectors have equal scores.
    """
    out = []
    reach = np.sqrt((vectors**2).sum(axis=1).max())
    for at in range(0, len(queries), 256):
        own, own_ids = queries[at : at + 256], query_ids[at : at + 256]
        sims = own @ vectors.T
        sims[own_ids[:, None] == ids[None, :]] = -np.inf
        last = np.partition(sims, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))]
        # More than rounding can change a product of 1e5 components.
        margin = 1e-10 * reach * np.sqrt((own**2).sum(axis=1))
        floor = floors[at : at + 256]
        last = np.maximum(last, floor)
        q, r = np.nonzero((sims >= (last - margin)[:, None]) & (sims > -np.inf))
        score = exact_products(own[q], vectors[r])
        enough = score >= floor[q]
        q, r, score = q[enough], r[enough], score[enough]
        order = np.lexsort((ids[r], -score, q))
        q, r, score = q[order], r[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        kept = rank < k
        out.append((own_ids[q[kept]], ids[r[kept]], score[kept]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _routed(rows: DataFrame, router: Router, sizes: np.ndarray | None, probes: int, least: int) -> DataFrame:
    """Add ``part``: the likeliest partition, or for queries one row for each probed one.

    A query probes ``probes`` partitions, and more until they hold ``least`` rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ranked = _ranked(router.logits(_matrix(batch.column(1))))
            if sizes is None:
                n = np.ones(len(ranked), dtype=np.int64)
            else:
                held = sizes[ranked].cumsum(axis=1)
                n = np.minimum(np.maximum(probes, (held < least).sum(axis=1) + 1), len(sizes))
            rows_ = np.repeat(np.arange(len(ranked)), n)
            turn = np.arange(len(rows_)) - np.repeat(n.cumsum() - n, n)
            taken = batch.take(pa.array(rows_))
            yield pa.RecordBatch.from_arrays(
                [
                    taken.column(0), taken.column(1),
                    pa.array(ranked[rows_, turn].astype(np.int32)), pa.array(turn.astype(np.int32)),
                ],
                ["vec_id", "vector", "part", "probe"],
            )

    return rows.mapInArrow(run, "vec_id bigint, vector array<double>, part int, probe int")


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
    vector_column: str = "embedding", sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest other rows that are found.

    Nearness is the largest inner product, in double precision; ties go to the smaller
    id. The rows for which ``is_query`` holds ask all rows.

    From a sample of at most ``sample_rows`` vectors, chosen by a hash of the id: a
    neighbour graph, its balanced partition, a small network that gives a vector's
    likely partitions, and how many a query must probe. Every row is then indexed in its
    likeliest partition. Partitions and their queries are compared in blocks of
    BLOCK_ROWS, so a partition with any share of the rows is spread over many tasks. The
    likeliest partition comes first; of the others, a block returns only rows that are as
    good as the k-th best found there, which loses nothing.

    Rows with a null id, or whose vector is null, empty, zero, of another length than
    most, or holds null or non-finite components take no part. Of rows that share an id,
    the one with the smallest vector counts. Other columns are ignored. Where fewer than
    k other rows exist, all are found; no rows give no rows.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_column).cast("array<double>")
    # The query condition is over the columns of ``vectors``, so it is evaluated on them.
    rows = materialized(
        vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), vector.alias("vector"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"))
        .where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
        .groupBy("vec_id").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks")),
        "vectors",
    )
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return empty
    rows = rows.where(F.size("vector") == lengths["d"])
    n = lengths["count"]
    place = F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1 << 30))
    likely = int((1 << 30) * min(1.0, 1.2 * sample_rows / n))
    sample = _matrix(
        rows.where(place <= likely).orderBy(place, "vec_id").limit(sample_rows)
        .select("vector").toArrow().column(0).combine_chunks()
    )
    parts = int(np.clip(n // PARTITION_ROWS, 1, min(MOST_PARTITIONS, max(len(sample) // 20, 1))))
    router, probes = fit(sample, parts, k)

    index = materialized(_routed(rows.select("vec_id", "vector"), router, None, 1, 0), "index")
    sizes = np.zeros(parts, dtype=np.int64)
    for r in index.groupBy("part").count().collect():
        sizes[r["part"]] = r["count"]
    asked = materialized(
        _routed(rows.where("asks").select("vec_id", "vector"), router, sizes, probes, 4 * k), "queries"
    )
    per_part = asked.groupBy("part").count().collect()
    turns = np.ones(parts, dtype=np.int64)
    for r in per_part:
        turns[r["part"]] = -(-r["count"] // BLOCK_ROWS)
    blocks = np.maximum(-(-sizes // BLOCK_ROWS), 1)

    def of_part(values: np.ndarray) -> Column:
        return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("part") + 1)

    def dealt(frame: DataFrame, own: str, own_n: np.ndarray, other: str, other_n: np.ndarray) -> DataFrame:
        """Each row in one of its own blocks, and before every block of the other side."""
        return frame.withColumn(own, F.pmod(F.xxhash64("vec_id"), of_part(own_n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), of_part(other_n) - 1))
        )

    # Partitions that no query probes are left out: nobody asks for their rows.
    probed = [r["part"] for r in per_part]
    data = dealt(index.where(F.col("part").isin(probed)), "block", blocks, "turn", turns)
    keys = ["part", "block", "turn"]

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not len(left) or not len(right):
            return schema.empty_table()
        found = best_of_block(
            left.column("vec_id").to_numpy(), _matrix(left.column("vector").combine_chunks()),
            right.column("vec_id").to_numpy(), _matrix(right.column("vector").combine_chunks()),
            right.column("floor").to_numpy(), k,
        )
        return pa.table([pa.array(c) for c in found], schema=schema)

    def nearest(asking: DataFrame) -> DataFrame:
        ask = dealt(asking, "turn", turns, "block", blocks)
        return data.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInArrow(
            compare, "query_id bigint, vec_id bigint, score double"
        )

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    lowest = F.lit(float("-inf"))
    first = asked.where("probe = 0").withColumn("floor", lowest)
    home = materialized(best(nearest(first)), "nearest")
    floors = home.where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("floor")
    )
    others = asked.where("probe > 0").join(floors, "vec_id", "left").withColumn(
        "floor", F.coalesce("floor", lowest)
    )
    near = home.drop("rank").unionAll(nearest(others))
    return best(near).select("query_id", "rank", "vec_id", "score")
