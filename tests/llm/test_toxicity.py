from __future__ import annotations

import zlib

import numpy as np

from tallywood.llm import toxicity
from tallywood.llm.queries import QUERIES


def test_query_on_held_out_rows(spark, folder):
    folder = folder.replace("sf0.001", "sf0.1")
    toxic = dict(
        spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").collect()
    )
    rows = QUERIES["op5_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert bad and good and auc > 0.9
    assert sum(s >= 0.3 for s in bad) >= 0.85 * len(bad)
    assert sum(s >= 0.3 for s in good) <= 0.02 * len(good)


def test_pairs_that_no_sum_of_weights_separates():
    rng = np.random.default_rng(0)
    rows = [[int(a), int(b)] for a, b in rng.integers(0, 2, (600, 2)) + [0, 2]]
    toxic = np.array([float(a == b - 2) for a, b in rows])
    machine = toxicity.fit_machine(
        np.arange(4), rows, toxic, np.ones(len(rows)), epochs=40, batch=64
    )
    for a in (0, 1):
        for b in (2, 3):
            assert (machine.score([a, b]) > 0.5) == (a == b - 2)


def test_training_finds_pairs_whose_words_say_nothing_alone(spark):
    rng = np.random.default_rng(3)
    filler = [f"word{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(4000):
        a, b = rng.integers(0, 2, 2)
        words = [*rng.choice(filler, 12), *["group"] * a, *["insult"] * b]
        docs.append((i, " ".join(rng.permutation(words))))
        labels.append((i, int(a == b)))
    machine = toxicity.train(
        spark.createDataFrame(docs[:3000], "doc_id int, text string"),
        spark.createDataFrame(labels[:3000], "doc_id int, toxic int"),
    )
    held = spark.createDataFrame(docs[3000:], "doc_id int, text string")
    found = {r.row.doc_id: r.score for r in toxicity.score(held, machine).collect()}
    assert np.mean([(found[i] >= 0.5) == t for i, t in labels[3000:]]) > 0.97


def test_score_and_pair_tests_equal_sums_over_pairs():
    rng = np.random.default_rng(5)
    machine = toxicity.FactorizationMachine(
        np.arange(9), 0.3, rng.normal(size=9), rng.normal(size=(9, 4)) / 3
    )
    rows = [np.flatnonzero(rng.random(9) < 0.5) for _ in range(50)]
    for r in rows:
        z = 0.3 + machine.weights[r].sum() + sum(
            machine.factors[a] @ machine.factors[b] for a in r for b in r if a < b
        )
        assert abs(machine.score(r) - 1 / (1 + np.exp(-z))) < 1e-12
    error, weight = rng.normal(size=50), rng.choice([1.0, 2.5], 50)
    expected = set()
    for a in range(9):
        for b in range(a):
            both = [i for i, r in enumerate(rows) if a in r and b in r]
            slope = sum(error[i] * weight[i] for i in both)
            if both and slope**2 / (0.2 * sum(weight[i] ** 2 for i in both)) >= 8:
                expected |= {a, b}
    found = toxicity.interacting(rows, 9, error, weight, 0.2, 8.0, block=4)
    assert expected and set(found.tolist()) == expected


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "you idiot there", 1), (2, None, 2), (None, "nice", 3), (4, "", 4), (4, "", 4),
         (5, "fine " * 50_000, 5)] + [(10 + i, f"idiot scum {i}", 6) for i in range(40)]
        + [(60 + i, f"nice day {i}", 7) for i in range(40)],
        "doc_id int, text string, score int",
    )
    labels = spark.createDataFrame(
        [(10 + i, 1, "x") for i in range(40)] + [(60 + i, 0, "x") for i in range(40)]
        + [(None, 1, "x"), (999, 1, "x"), (60, None, "x"), (10, 0, "x")],
        "doc_id int, toxic int, text string",
    )
    machine = toxicity.train(docs, labels)
    found = toxicity.score(docs, machine).collect()
    assert len(found) == docs.count()
    scores = {(r.row.doc_id, r.row.text): r.score for r in found}
    assert scores[10, "idiot scum 0"] > 0.8 and scores[60, "nice day 0"] < 0.2
    assert scores[2, None] == scores[4, ""]
    assert toxicity.score(docs.limit(0), machine).count() == 0
    blank = toxicity.train(docs, labels.limit(0))
    assert {round(r.score, 6) for r in toxicity.score(docs, blank).collect()} == {0.5}
