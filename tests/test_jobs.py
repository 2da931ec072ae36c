"""The ready-made jobs on small files in their layouts."""

from __future__ import annotations

import random

import pytest

from tallywood.learning import jobs
from tallywood.sources import layouts


@pytest.fixture(scope="module")
def rng():
    return random.Random(3)


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.mark.parametrize(
    ("kind", "grid"),
    [
        ("linear_regression", {"maxIter": [20], "regParam": [0.001]}),
        ("forest_regression", {"numTrees": [5], "maxDepth": [4]}),
    ],
)
def test_claims(spark, tmp_path, rng, kind, grid):
    lines = ["id,cat1,cat109,cont1,cont2,loss"]
    for i in range(400):
        cat, a, b = rng.choice("ABC"), rng.random(), rng.random()
        loss = 100 * a + (50 if cat == "B" else 0) + 5 * b
        lines.append(f"{i},{cat},x{i},{a},{b},{loss}")
    test_lines = ["id,cat1,cat109,cont1,cont2"]
    test_lines += [f"{i},{rng.choice('ABCD')},y{i},{rng.random()}," for i in range(1000, 1040)]
    train = layouts.read_claims(spark, write(tmp_path / "train.csv", lines))
    test = layouts.read_claims(spark, write(tmp_path / "test.csv", test_lines))
    assert dict(train.dtypes)["cat1"] == "string" and dict(train.dtypes)["loss"] == "double"
    found = jobs.claims_severity(train, test, kind, grid, folds=2)
    out = found.predictions.collect()
    assert found.predictions.columns == ["id", "loss"] and len(out) == 40
    assert found.reports["train"].head()["r2"] > 0.7
    assert found.reports["validation"].head()["r2"] > 0.6
    assert found.reports["grid"].count() == len(found.model.avgMetrics)


def account(rng, i):
    plan, minutes = rng.choice(["Yes", "No"]), rng.uniform(50, 300)
    churn = str(plan == "Yes" and minutes > 180)
    numbers = [rng.uniform(1, 100) for _ in range(13)]
    numbers[1] = minutes
    return ",".join(["KS", str(i % 200), "415", plan, "No", *map(str, numbers), "3", churn])


@pytest.mark.parametrize(
    ("kind", "grid"),
    [("tree", {"maxDepth": [4]}), ("logistic", {"regParam": [0.01], "maxIter": [20]})],
)
def test_churn(spark, tmp_path, rng, kind, grid):
    path = write(tmp_path / "train.csv", [account(rng, i) for i in range(900)])
    test_path = write(tmp_path / "test.csv", [account(rng, i) for i in range(200)])
    train = layouts.read_churn_accounts(spark, path)
    assert len(train.columns) == 20
    fractions = {"False": 0.5, "True": 1.0}
    test = layouts.read_churn_accounts(spark, test_path)
    found = jobs.churn_classification(train, test, kind, grid, folds=2, fractions=fractions)
    assert found.reports["outcomes"].head()["total"] == 200
    assert found.reports["areas"].head()["area_under_roc"] > (0.9 if kind == "tree" else 0.6)
    totals = jobs.churn_totals(train).collect()
    assert [r["churn"] for r in totals][0] == "False"
    assert totals[0]["Total_charge"] >= totals[1]["Total_charge"]


@pytest.mark.parametrize("decoded", [True, False])
def test_cover(spark, tmp_path, rng, decoded):
    lines = []
    for _ in range(600):
        numbers = [rng.randrange(1000) for _ in range(10)]
        area, soil = rng.randrange(4), rng.randrange(40)
        hot = [int(i == area) for i in range(4)] + [int(i == soil) for i in range(40)]
        lines.append(",".join(map(str, [*numbers, *hot, 1 + area])))
    data = layouts.read_cover(spark, write(tmp_path / "cover.csv", lines))
    assert len(data.columns) == 55 and dict(data.dtypes)["Cover_Type"] == "double"
    train, test = data.randomSplit([0.8, 0.2], 1)
    found = jobs.cover_classification(
        train, test, "tree", {"impurity": ["gini"], "maxDepth": [4]}, decoded, maxBins=64
    )
    assert found.reports["accuracy"].head()["accuracy"] > 0.95
    assert 0.1 < found.reports["baseline"].head()["accuracy"] < 0.5
    top = found.reports["importances"].head()["feature"]
    assert top == "wilderness" if decoded else top.startswith("Wilderness_Area")
    assert len(found.reports["confusion"].columns) == 8


def test_network(spark, tmp_path, rng):
    lines = []
    for i in range(300):
        numbers = [rng.randrange(5) for _ in range(38)]
        if i == 7:
            numbers = [10_000] * 38
        fields = [numbers[0], rng.choice(["tcp", "udp"]), rng.choice(["http", "ftp"]), "SF"]
        lines.append(",".join(map(str, [*fields, *numbers[1:], "normal."])))
    data = layouts.read_network(spark, write(tmp_path / "network.csv", lines))
    assert len(data.columns) == 42
    out = jobs.network_anomalies(data, k=2, rank=3)
    assert out.columns == data.columns and out.count() >= 3


def test_recommender(spark, tmp_path, rng):
    plays = []
    for user in range(60):
        for item in range(80):
            if rng.random() < (0.7 if item < 20 else 0.1):
                plays.append(f"{user} {item} {rng.randrange(1, 9)}")
    plays.append("broken line")
    aliases = ["79\t0", "\t5", "78\t1"]
    items = ["1\tFirst Name", "x\tbad", "2\tSecond"]
    known = layouts.read_items(spark, write(tmp_path / "items.txt", items))
    assert sorted(r["name"] for r in known.collect()) == ["First Name", "Second"]
    found = jobs.recommender_auc(
        layouts.read_plays(spark, write(tmp_path / "plays.txt", plays)),
        layouts.read_aliases(spark, write(tmp_path / "alias.txt", aliases)),
        rank=4,
        maxIter=3,
    ).collect()
    auc = {r["scores"]: r["auc"] for r in found}
    assert 0.6 < auc["popularity"] < 1 and 0.5 < auc["factors"] < 1
