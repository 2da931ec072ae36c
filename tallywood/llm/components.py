"""Connected components of an undirected graph, as a series of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.plans.scratch import materialized


def _smallest(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with ``low``, the smallest of a and all its b.

    The minimum is aggregated before the shuffle, so a vertex with very many
    edges costs one row a task; its edges are joined by Spark's sort-merge join,
    which splits a skewed vertex at run time.
    """
    lows = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return edges.join(lows, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = _smallest(both).where("b > a")
    return linked.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Of edges with a > b."""
    linked = _smallest(edges)
    return (
        linked.select(F.inline(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
        )))
        .where("a != b")
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex with an edge; component: the smallest vertex.

    ``edges``: two columns of one ordered type; direction, loops and repeats do
    not matter. Alternating large-star and small-star steps: each keeps the
    components and no more edges than before, and after about log n rounds every
    vertex points at the smallest one. Each round is written to the shared folder.
    """
    low, high = (F.col(c) for c in edges.columns)
    edges = edges.select(F.greatest(low, high).alias("a"), F.least(low, high).alias("b"))
    edges = materialized(edges.where("a != b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionAll(
                edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
            )
        before = state
        edges = materialized(_small_star(_large_star(edges)), "edges")
