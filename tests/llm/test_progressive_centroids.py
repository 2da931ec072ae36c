from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tallywood.llm import progressive_centroids as op
from tallywood.llm.queries import QUERIES


def plain(rows: list[tuple], k: int = 40, rounds: int = 5) -> dict:
    """Cluster, distance and final centroid of each row, by all distances."""
    xs = [[math.floor(256 * float(x)) for x in v] for _, v in rows]
    order = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(f"2:{rows[i][0]}".encode()).hexdigest(), rows[i][1]))
    centroids = [list(xs[i]) for i in order[:k] if rows[i][0] is not None]

    def assigned():
        found = []
        for x in xs:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            found.append((min(d), d.index(min(d))))
        return found

    for _ in range(rounds):
        found = assigned()
        for c in range(len(centroids)):
            own = [x for x, (_, n) in zip(xs, found) if n == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    return [(r[0], n, d, centroids[n]) for r, (d, n) in zip(rows, assigned())]


def test_transform_keeps_distances():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-500, 500, (2, 20, 64))
    ta, tb = op.transform(a), op.transform(b)
    assert (((ta - tb) ** 2).sum(axis=1) == 64 * ((a - b) ** 2).sum(axis=1)).all()
    signs = op.transform(np.eye(64, dtype=np.int64))[op.sequency()]
    assert [(r[1:] != r[:-1]).sum() for r in signs] == list(range(64))


@pytest.mark.parametrize("size", [3, 300, 1 << 27])
def test_nearest_is_exact_with_ties(size):
    rng = np.random.default_rng(size)
    x, c = rng.integers(-size, size, (200, 64)), rng.integers(-size, size, (30, 64))
    c[7], c[20], x[5] = c[3], c[2], c[2]
    number, distance = op.nearest(x, c)
    whole = ((x[:, None].astype(object) - c[None].astype(object)) ** 2).sum(axis=2)
    assert number.tolist() == [row.tolist().index(min(row)) for row in whole]
    assert distance.tolist() == [min(row) for row in whole]


def test_query_matches_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = plain(rows)
    sums: dict = {}
    for _, n, d, _ in expected:
        sums[n] = sums.get(n, 0) + d
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    want = sorted((i, n, d, sums[n], sum(sums.values()), sha(c)) for i, n, d, c in expected)
    assert sorted(map(tuple, QUERIES["op11_progressive_centroids"](spark, folder).collect())) == want


def test_query_matches_sql(same_as_sql):
    same_as_sql("op11_progressive_centroids")


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    whole = [(i, rng.normal(size=64).round(3).tolist()) for i in range(50)]
    whole += [(3, whole[3][1]), (3, whole[4][1]), (70, whole[0][1]), (71, [0.0] * 64), (None, whole[1][1])]
    odd = [(80, None), (81, [1.0] * 63), (82, [1.0] * 63 + [None]), (83, [1.0] * 63 + [math.nan]),
           (84, [math.inf] + [1.0] * 63), (85, []), (86, [1.0] * 65)]
    rows = [(i, v, 9, "x") for i, v in whole + odd]
    schema = "vec_id bigint, embedding array<double>, cluster int, vector string"
    found = op.cluster(spark.createDataFrame(rows, schema).repartition(5)).collect()
    assert len(found) == len(whole)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    expected = [r[:3] for r in plain(sorted(whole, key=lambda r: r[0] is None))]
    assert sorted([tuple(r)[:3] for r in found], key=key) == sorted(expected, key=key)
    few = op.cluster(spark.createDataFrame(rows[:6], schema)).collect()
    assert {r.distance for r in few} == {0} and len({r.cluster for r in few}) == 6
    none = spark.createDataFrame(odd, "vec_id bigint, embedding array<double>")
    assert op.cluster(none).count() == 0
    with pytest.raises(Exception, match="no exact distance"):
        op.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<double>"))
