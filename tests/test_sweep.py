"""Sweeps over numbers of clusters against Lloyd's steps on plain arrays."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywood.learning import sweep

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    return rng.integers(0, 40, (500, 2)).astype(float)


@pytest.fixture(scope="module")
def rows(spark, points):
    data = [(i, float(a), float(b), i % 3) for i, (a, b) in enumerate(points)]
    return spark.createDataFrame(data, "id int, a double, b double, label int").repartition(5)


def lloyd(points, k, iterations, tolerance):
    centers = points[:k].copy()
    for step in range(1, iterations + 1):
        nearest = ((points[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([points[nearest == c].mean(axis=0) if (nearest == c).any() else centers[c] for c in range(k)])
        moved = np.sqrt(((new - centers) ** 2).sum(axis=1).max())
        centers = new
        if moved <= tolerance:
            break
    return centers, step


def test_every_k_equals_its_own_run_and_shares_the_scans(rows, points, monkeypatch):
    scans = []
    plain = sweep.cluster_sums
    monkeypatch.setattr(sweep, "cluster_sums", lambda *a: scans.append(sorted(a[2])) or plain(*a))
    ks = [1, 3, 7, 12]
    fitted = sweep.fit_all(rows, COLUMNS, ks, F.col("id"), iterations=30)
    for k in ks:
        centers, steps = lloyd(points, k, 30, 1e-5)
        assert fitted[k].steps == steps
        assert fitted[k].centers == pytest.approx(centers, abs=1e-9)
    assert len(scans) == max(f.steps for f in fitted.values()) and scans[0] == ks


def test_costs_and_entropies_equal_those_of_the_arrays(rows, points):
    fitted = sweep.fit_all(rows, COLUMNS, [2, 9], F.col("id"), iterations=5)
    found = {r.k: r for r in sweep.costs(rows, COLUMNS, fitted).collect()}
    spread = {r.k: r.entropy for r in sweep.label_entropies(rows, COLUMNS, fitted, "label").collect()}
    labels = np.arange(len(points)) % 3
    for k in (2, 9):
        apart = ((points[:, None] - fitted[k].centers[None]) ** 2).sum(axis=2)
        nearest = apart.argmin(axis=1)
        assert found[k].cost == pytest.approx(apart.min(axis=1).sum())
        assert found[k].n_clusters == len(set(nearest))
        entropy = 0.0
        for c in set(nearest):
            shares = np.bincount(labels[nearest == c], minlength=3) / (nearest == c).sum()
            entropy -= (nearest == c).mean() * sum(s * np.log(s) for s in shares if s)
        assert spread[k] == pytest.approx(entropy)


def test_odd_rows(spark):
    data = [(1, 0.0, 0.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, float("inf"), 1.0), (5, 4.0, 0.0), (6, 4.0, 0.0)]
    frame = spark.createDataFrame(data, "id int, a double, b double")
    fitted = sweep.fit_all(frame, COLUMNS, [2, 5], F.col("id"))
    assert len(fitted[5].centers) == 3 and fitted[2].settled
    # Equal rows start two clusters, and the second stays empty.
    found = {r.k: (r.n_clusters, r.cost) for r in sweep.costs(frame, COLUMNS, fitted).collect()}
    assert found == {2: (2, 0.0), 5: (2, 0.0)}
    none = sweep.fit_all(frame.limit(0), COLUMNS, [2], F.col("id"))
    assert len(none[2].centers) == 0
    assert sweep.costs(frame.limit(0), COLUMNS, none).count() == 0
    with pytest.raises(ValueError, match="1 or more"):
        sweep.fit_all(frame, COLUMNS, [0], F.col("id"))
