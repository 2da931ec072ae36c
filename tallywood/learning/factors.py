"""Factorisations as tables: their normal equations as aggregates, exact best products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywood.plans import materialized, number_rows

# Items of a block and queries that meet a block in one task.
BLOCK_ITEMS, BLOCK_QUERIES = 4096, 4096


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _sums(vector: Column, size: int) -> Column:
    return F.array(*[F.sum(vector[k]) for k in range(size)])


def equation_residuals(
    ratings: DataFrame, own: DataFrame, other: DataFrame, user: str, item: str, count: str,
    rank: int, penalty: float, alpha: float = 1.0,
) -> DataFrame:
    """(user, n, residual): how far each factor of ``own`` is from solving its equations.

    ``own`` and ``other`` are (id, features) as a fitted model holds them. With the others'
    factors y fixed, implicit feedback asks of a factor x that
    (sum y y' + sum c y y' + penalty n I) x = sum (1 + c) y, where the first sum is over all
    y, the others over the n rated ones, and c = alpha times the rating's absolute value;
    ratings of zero or less count in c alone. The residual is the length of the difference
    relative to that of the right side (1 where that is zero). No factor is solved for: all is sums, combined
    before the shuffle. A rating without factors on either side is left out, as in the fit.
    """
    y = F.col("features").cast("array<double>")
    gram = other.select(y.alias("y")).agg(
        *[F.sum(F.col("y")[i] * F.col("y")[j]) for i in range(rank) for j in range(rank)]
    ).head()
    rows = [F.array(*[F.lit(float(gram[i * rank + j] or 0.0)) for j in range(rank)]) for i in range(rank)]
    # Factors and ratings cross the shuffles in single precision, as the model holds them.
    met = (
        ratings.select(user, item, F.col(count).cast("float").alias("_r"))
        .join(other.select(F.col("id").alias(item), F.col("features").alias("_y")), item)
        .join(own.select(F.col("id").alias(user), F.col("features").alias("_x")), user)
    )
    met = met.withColumns({
        "_r": F.col("_r").cast("double"),
        "_x": F.col("_x").cast("array<double>"), "_y": F.col("_y").cast("array<double>"),
    })
    liked = F.when(F.col("_r") > 0, 1.0).otherwise(0.0)
    met = met.withColumn("_c", alpha * F.abs("_r")).withColumn("_b", liked * (1 + F.col("_c")))
    met = met.withColumn("_a", F.col("_c") * _dot(F.col("_x"), F.col("_y")))
    sums = met.groupBy(user).agg(
        F.first("_x").alias("x"), F.sum(liked).cast("bigint").alias("n"),
        _sums(F.transform("_y", lambda v: v * F.col("_a")), rank).alias("left"),
        _sums(F.transform("_y", lambda v: v * F.col("_b")), rank).alias("right"),
    )
    x, n = F.col("x"), F.col("n")
    off = F.array(*[
        _dot(rows[k], x) + F.col("left")[k] + penalty * n * x[k] - F.col("right")[k] for k in range(rank)
    ])
    by_right = F.sqrt(_dot(F.col("right"), F.col("right")))
    length = F.when(by_right > 0, by_right).otherwise(1.0)
    return sums.select(user, "n", off.alias("_off"), length.alias("_length")).select(
        user, "n", (F.sqrt(_dot(F.col("_off"), F.col("_off"))) / F.col("_length")).alias("residual")
    )


def _block_best(asked: pa.Table, members: pa.Table, n: int) -> pa.Table:
    """The ``n`` best items of a block for each query, those that can still be among its best."""
    out: tuple[list, list, list] = ([], [], [])
    if asked.num_rows and members.num_rows:
        items = np.array(members.column("item").to_pylist(), dtype=np.int64)
        own = np.array(members.column("v").to_pylist(), dtype=np.float64)
        order = np.argsort(items, kind="stable")
        items, own = items[order], own[order]
        reach = np.sqrt((own * own).sum(axis=1)).max()
        for query, v, least in zip(*(asked.column(c).to_pylist() for c in ("query", "v", "least"))):
            v = np.array(v, dtype=np.float64)
            if least is not None and np.sqrt(v @ v) * reach * (1 + 1e-9) < least:
                continue
            scores = own @ v
            # Ascending items, so a stable order puts the smaller of equal scores first.
            best = np.argsort(-scores, kind="stable")[:n]
            if least is not None:
                best = best[scores[best] >= least]
            out[0].extend([query] * len(best))
            out[1].extend(items[best].tolist())
            out[2].extend(scores[best].tolist())
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], ["query", "item", "score"])


def top_products(queries: DataFrame, items: DataFrame, n: int, block: int = BLOCK_ITEMS) -> DataFrame:
    """(query, rank, item, score): each query's ``n`` items of largest inner product, exactly.

    ``queries`` (query, v) and ``items`` (item, v) hold vectors of one length. Items lie in
    blocks by falling length. As |x||y| bounds a product, a query is done as soon as its
    n-th best score is above its length times the longest item left; the blocks open in
    doubling rounds to those queries that are not done. Nothing is skipped on a guess.

    Ranks count from 1, equal scores by smaller item. Null ids and vectors that are null or
    hold a null or non-finite number take no part; fewer items than ``n`` give fewer rows.
    """
    usable = F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    vector = F.col("v").cast("array<double>").alias("v")
    length = F.sqrt(_dot(F.col("v"), F.col("v")))
    asking = queries.select(F.col("query").cast("bigint").alias("query"), vector).where(usable)
    asking = materialized(asking.dropna().withColumn("size", length), "asking")
    stored = items.select(F.col("item").cast("bigint").alias("item"), vector).where(usable).dropna()
    numbered = number_rows(stored.withColumn("size", length), [F.desc("size"), F.asc("item")], "_at")
    at = F.floor(F.col("_at") / block).alias("block")
    placed = materialized(numbered.select("item", "v", "size", at), "blocks")
    last, chunks = placed.agg(F.max("block")).head()[0], -(-asking.count() // BLOCK_QUERIES)
    best = None
    start, end = 0, 1
    while last is not None and chunks and start <= last:
        part = placed.where((F.col("block") >= start) & (F.col("block") < end))
        if best is None:
            alive = asking.withColumn("least", F.lit(None).cast("double"))
        else:
            longest = part.agg(F.max("size")).head()[0]
            least = best.groupBy("query").agg(
                F.when(F.count(F.lit(1)) >= n, F.min("score")).alias("least")
            )
            open_still = F.col("least").isNull() | (F.col("size") * longest * (1 + 1e-9) >= F.col("least"))
            alive = materialized(asking.join(least, "query", "left").where(open_still), "alive")
            if alive.isEmpty():
                break
        spread = F.pmod(F.xxhash64("query"), F.lit(chunks))
        blocks = F.sequence(F.lit(start), F.lit(min(end - 1, last)))
        asked = alive.select("query", "v", "least", spread.alias("chunk"), F.explode(blocks).alias("block"))
        parts = F.explode(F.sequence(*[F.lit(c).cast("bigint") for c in (0, chunks - 1)])).alias("chunk")
        members = part.select("item", "v", F.col("block").cast("int").alias("block"), parts)
        found = asked.groupBy("block", "chunk").cogroup(members.groupBy("block", "chunk")).applyInArrow(
            lambda left, right: _block_best(left, right, n), "query bigint, item bigint, score double"
        )
        pool = found if best is None else best.select("query", "item", "score").unionAll(found)
        best = materialized(_ranked(pool, n), "best")
        start, end = end, 2 * end
    if best is None:
        best = _ranked(asking.sparkSession.createDataFrame([], "query bigint, item bigint, score double"), n)
    return best.select("query", "rank", "item", "score")


def _ranked(pool: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "item")
    return pool.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
