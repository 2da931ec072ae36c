"""K-means over lines of points against Lloyd's steps on plain arrays."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywood.learning import cluster, lines

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    whole = np.column_stack([rng.integers(0, 3, 3000), rng.normal(0, 20, 3000), rng.integers(0, 2, 3000)])
    whole[2500:, 0] = rng.normal(0, 3, 500)  # short lines too
    whole[:400] = whole[0]
    return whole.astype(float)


@pytest.fixture(scope="module")
def rows(spark, points):
    data = [(*map(float, p), i % 3 or None) for i, p in enumerate(points)]
    odd = [(None, 1.0, 1.0, 1), (1.0, float("nan"), 1.0, 1), (float("inf"), 0.0, 0.0, 1)]
    return spark.createDataFrame(data + odd, "a double, b double, c double, label int").repartition(3)


@pytest.fixture(scope="module")
def held(rows):
    return lines.lines(rows, COLUMNS)


def apart(points, centers):
    return ((points[:, None] - centers[None]) ** 2).sum(axis=2)


@pytest.mark.parametrize("k", [1, 2, 17, 200])
def test_sums_equal_those_of_all_pairs(held, points, k):
    centers = np.random.default_rng(k).normal(0, 10, (k, 3))
    centers[0] = points[7]
    away = apart(points, centers)
    near = away.argmin(axis=1)
    found = {r.cluster: r for r in lines.cluster_sums(held, {k: centers}).collect()}
    assert sorted(found) == sorted(set(near))
    for c, row in found.items():
        own = points[near == c]
        assert row.n == len(own)
        assert row.cost == pytest.approx(away[near == c, c].sum(), abs=1e-6)
        assert [row.s0, row.s1, row.s2] == pytest.approx(own.sum(axis=0), abs=1e-6)


def test_a_fit_settles_where_no_step_moves_it(held, points):
    fitted = lines.fit_all(held, [3, 12], iterations=200, tolerance=1e-9)
    found = {r.k: r.cost for r in lines.costs(held, fitted).collect()}
    for k in (3, 12):
        assert fitted[k].settled and len(fitted[k].centers) == k
        away = apart(points, fitted[k].centers)
        near = away.argmin(axis=1)
        for c in set(near):
            assert points[near == c].mean(axis=0) == pytest.approx(fitted[k].centers[c], abs=1e-6)
        assert found[k] == pytest.approx(away.min(axis=1).sum())
    assert found[12] < found[3]


def test_labels_are_counted_with_null_ones(rows, held, points):
    fitted = lines.fit_all(held, [5], iterations=3)
    counts = lines.label_counts(lines.lines(rows, COLUMNS, ["label"]), fitted, "label").collect()
    near = apart(points, fitted[5].centers).argmin(axis=1)
    labels = np.arange(len(points)) % 3
    expected = {(c, label or None): int(((near == c) & (labels == label)).sum()) for c in range(5) for label in range(3)}
    assert {(r.cluster, r.label): r["count"] for r in counts} == {k: n for k, n in expected.items() if n}


def test_a_sweep_shares_scans_that_do_not_grow_with_the_rows(spark, monkeypatch):
    """One scan a step for all k; and lines, not rows, are what a scan reads."""
    scans = []
    plain = lines.cluster_sums
    monkeypatch.setattr(lines, "cluster_sums", lambda h, c: scans.append(h.table.count()) or plain(h, c))
    frame = spark.range(20_000).select((F.col("id") % 4).cast("double").alias("x"), F.rand(3).alias("y"))
    prepared = cluster.prepare(frame, cluster.feature_stages(["x", "y"])[0])
    found = cluster.cost_sweep(prepared, "features", [2, 5, 9], maxIter=4, tol=1e-5)
    assert [k for k, _ in found] == [2, 5, 9] and found[0][1] > found[2][1]
    # Two costs while points are drawn, their weights, four steps, the costs.
    assert len(scans) <= 8 and max(scans) < 200


def test_few_points_and_none(spark, rows):
    few = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (4.0, 2.0)], "a double, b double")
    fitted = lines.fit_all(lines.lines(few, ["a", "b"]), [2, 9])
    assert sorted(map(tuple, fitted[9].centers)) == [(1.0, 2.0), (4.0, 2.0)]
    none = lines.lines(few.limit(0), ["a", "b"])
    assert len(lines.fit_all(none, [2])[2].centers) == 0
    with pytest.raises(ValueError, match="1 or more"):
        lines.fit_all(none, [0])


def test_anomalies_keep_columns_and_ties(spark):
    data = [(float(i % 5), "a", i) for i in range(50)] + [(500.0 + i % 5, "b", i) for i in range(50, 100)]
    data += [(560.0, "b", 100), (560.0, "b", 101)]
    frame = spark.createDataFrame(data, "x double, c string, id int")
    out = cluster.anomalies(frame, ["x"], ["c"], 2, rank=1, maxIter=5)
    assert out.columns == ["x", "c", "id", "distance"]
    assert sorted(r["id"] for r in out.collect()) == [100, 101]


def test_stretches_are_halved_not_followed_one_by_one(monkeypatch):
    """A line that 150 centers share takes rounds by their logarithm; ties and equal centers included."""
    rng = np.random.default_rng(2)
    x = np.sort(np.append(rng.integers(0, 4000, 3000), [7, 7, 9] * 20)).astype(float)
    places = np.arange(0, 4000, 27.0)
    centers = np.column_stack([np.zeros(len(places) + 2), np.append(places, places[[3, 60]])])
    size = np.array([len(x) - 20, 20])
    block = lines._Block(np.array([[0.5], [2.0]]), np.append(x[:-20], x[:20]), np.ones(len(x), np.int64), np.cumsum(size) - size, np.cumsum(size))
    rounds, plain = [], lines._least
    monkeypatch.setattr(lines, "_least", lambda *a: rounds.append(len(a[1])) or plain(*a))
    seen = np.full(len(x), -1)
    for line, near, start, end in lines._stretches(block, centers, 1):
        for which, c, a, b in zip(line, near, start, end):
            assert block.first[which] <= a < b <= block.last[which] and (seen[a:b] == -1).all()
            seen[a:b] = c
    whole = np.column_stack([np.repeat(block.at[:, 0], size), block.x])
    away = apart(whole, centers)
    assert away[np.arange(len(x)), seen] == pytest.approx(away.min(axis=1))
    assert len(rounds) <= 20 and sum(rounds) <= 2 * len(centers) + 2


@pytest.mark.parametrize("categories", [[], ["flag"]])
def test_counted_rows_are_laid_out_as_the_rows_themselves(spark, categories):
    """One count of the table does for sweeps that ask for some of its columns, and lays out without a shuffle."""
    data = [(float(i % 3), float(i * i % 701), "ab"[i % 2] if i % 5 else None) for i in range(4000)]
    frame = spark.createDataFrame(data, "a double, b double, flag string").repartition(3)
    counted, along = cluster.counted_rows(frame, ["a", "b"], ["flag"])
    assert along == 1 and counted.count() == len(set(data)) < len(data)
    stages, vector = cluster.feature_stages(["a", "b"], categories, True)
    prepared, plain = cluster.prepare(frame, stages, counted), cluster.prepare(frame, stages)
    held = cluster.vector_lines(prepared, vector, (), along, "number")
    whole = np.array([r.v for r in plain.select(cluster.vector_to_array(vector).alias("v")).collect()])
    centers = whole[[0, 17, 400, 1203, 2999]] + 0.01 * np.arange(5)[:, None]
    away = apart(whole, centers)
    found = {r.cluster: r for r in lines.cluster_sums(held, {5: centers}).collect()}
    assert sum(r.n for r in found.values()) == len(data)
    for c, row in found.items():
        own = whole[away.argmin(axis=1) == c]
        assert row.n == len(own)
        assert [row[f"s{j}"] for j in range(whole.shape[1])] == pytest.approx(own.sum(axis=0), abs=1e-6)
        assert row.cost == pytest.approx(away[away.argmin(axis=1) == c, c].sum(), abs=1e-6)
    costs = cluster.cost_sweep(prepared, vector, [2, 9], along=along, number="number")
    assert [k for k, _ in costs] == [2, 9] and costs[0][1] > costs[1][1] >= 0


def test_steps_shuffle_sums_to_few_partitions(held):
    plan = lines.cluster_sums(held, {2: np.zeros((2, 3)), 600: np.ones((600, 3))})._jdf.queryExecution().toString()
    assert "hashpartitioning(k" in plan and ", 2), REPARTITION_BY_NUM" in plan
