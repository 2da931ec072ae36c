"""Normal equations of a factorisation and exact best products, against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywood.learning import factors, recommend

VECTORS = "array<double>"


def brute_force(queries, items, n):
    rows = set()
    for q, x in queries:
        scored = sorted(((-float(np.dot(x, y)), i) for i, y in items))[:n]
        rows |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)}
    return rows


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_best_products_equal_brute_force(spark, block):
    draw = np.random.default_rng(3)
    # Whole numbers, so that products are exact and many tie; lengths differ widely.
    items = [(i, (draw.integers(-4, 5, 3) * (1 + 40 * (i % 23 == 0))).tolist()) for i in range(120)]
    queries = [(q, draw.integers(-3, 4, 3).tolist()) for q in range(40)] + [(99, [0, 0, 0])]
    odd = [(500, [None, 1.0, 2.0]), (501, [float("nan"), 1.0, 2.0]), (502, None), (None, [9.0, 9.0, 9.0])]
    found = factors.top_products(
        spark.createDataFrame([(q, [float(x) for x in v]) for q, v in queries] + odd, f"query long, v {VECTORS}"),
        spark.createDataFrame([(i, [float(x) for x in v]) for i, v in items] + odd, f"item long, v {VECTORS}"),
        4, block,
    )
    assert {tuple(r) for r in found.collect()} == brute_force(queries, items, 4)


def test_best_products_of_few_or_no_items(spark):
    queries = spark.createDataFrame([(1, [1.0])], f"query long, v {VECTORS}")
    items = spark.createDataFrame([(5, [2.0]), (3, [2.0])], f"item long, v {VECTORS}")
    found = factors.top_products(queries, items, 9).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(1, 1, 3, 2.0), (1, 2, 5, 2.0)]
    assert factors.top_products(queries, items.limit(0), 9).count() == 0
    assert factors.top_products(queries.limit(0), items, 9).count() == 0


def test_fitted_factors_solve_their_equations_and_others_do_not(spark):
    rows = spark.range(900).select(
        (F.col("id") * 7 % 40).cast("int").alias("user"), (F.col("id") * 13 % 53).cast("int").alias("item"),
        (F.col("id") % 9 - 1).cast("float").alias("plays"),
    )
    rows = rows.groupBy("user", "item").agg(F.sum("plays").cast("float").alias("plays"))
    model = recommend.fit_als(rows, "user", "item", "plays", seed=3, rank=4, alpha=2.0, regParam=0.1)

    def residuals(own):
        found = factors.equation_residuals(rows, own, model.itemFactors, "user", "item", "plays", 4, 0.1, 2.0)
        return [r["residual"] for r in found.collect()]

    fitted = residuals(model.userFactors)
    assert len(fitted) == 40 and max(fitted) < 1e-3
    moved = model.userFactors.select("id", F.transform("features", lambda v: v * F.lit(1.01)).alias("features"))
    assert min(residuals(moved)) > 1e-3


def test_factors_cross_the_shuffles_as_the_model_holds_them(spark, plan_text):
    rated = spark.range(60).select((F.col("id") % 7).alias("u"), (F.col("id") % 11).alias("i"), F.lit(2).alias("c"))
    model = spark.range(11).select(F.col("id").cast("int").alias("id"), F.array(F.lit(0.5), F.col("id") / 4.0).cast("array<float>").alias("features"))
    found = factors.equation_residuals(rated, model.where("id < 7"), model, "u", "i", "c", 2, 0.1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = [line for line in plan_text(found).splitlines() if line.startswith("Arguments: hashpartitioning")]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    under = plan[plan.index("Join Inner") :]
    assert lines and "as array<double>)" not in under.split("\n", 1)[1]


def test_fit_does_not_cache_its_rows(spark, monkeypatch):
    rated = spark.range(60).select((F.col("id") % 7).alias("u"), (F.col("id") % 11).alias("i"), F.lit(2).alias("c"))
    monkeypatch.setattr(type(rated), "persist", None)
    assert recommend.fit_als(rated, "u", "i", "c", seed=1).rank == 10
