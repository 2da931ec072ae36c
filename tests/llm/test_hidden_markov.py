from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywood.llm import hidden_markov as hm
from tallywood.llm.queries import QUERIES


def small_model(states=2, seed=1):
    rng = np.random.default_rng(seed)
    emits = np.zeros((hm.CLASSES, states))
    emits[:4] = rng.dirichlet(np.ones(4), states).T
    return hm.HiddenMarkov(
        rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), emits,
        np.zeros(hm.CLASSES, np.int64), np.zeros(hm.CLASSES, np.int64),
    )


SEQUENCES = [[0, 1, 2, 3, 1], [2], [3, 3, 0], [1, 0, 2, 2, 1, 3]]


def paths(sequence, model):
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]] * model.emits[sequence[0], path[0]]
        for a, b, c in zip(path, path[1:], sequence[1:]):
            p *= model.moves[a, b] * model.emits[c, b]
        yield path, p


def test_forward_sums_over_all_paths():
    model = small_model(3)
    flat = np.array(sum(SEQUENCES, []))
    found = hm.forward(flat, np.array([len(s) for s in SEQUENCES]), model)
    expected = [math.log10(sum(p for _, p in paths(s, model))) for s in SEQUENCES]
    assert found == pytest.approx(expected, rel=1e-10)


def test_expected_counts_sum_over_all_paths():
    model = small_model(2)
    found = hm.Counts.zero(2)
    hm.expect(np.array(sum(SEQUENCES, [])), np.array([len(s) for s in SEQUENCES]), model, found)
    expected = hm.Counts.zero(2)
    for s in SEQUENCES:
        total = sum(p for _, p in paths(s, model))
        for path, p in paths(s, model):
            expected.start[path[0]] += p / total
            for c, z in zip(s, path):
                expected.emits[c, z] += p / total
            for a, b in zip(path, path[1:]):
                expected.moves[a, b] += p / total
    for name in ("start", "moves", "emits"):
        assert getattr(found, name) == pytest.approx(getattr(expected, name), abs=1e-4)


def test_windows_and_packing():
    lengths = np.array([5, 0, 12, 4, 8])
    assert hm._windows(lengths, 4).tolist() == [4, 1, 4, 4, 4, 4, 4, 4]
    values = np.array([0, 1, 70_000, 2**32 - 1])
    assert hm._unpacked(hm._packed(values), 4).tolist() == values.tolist()
    assert hm._unpacked(hm._packed(values[:0]), 0).tolist() == []


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lower = lower.replace(space, " ")
    return [w for w in lower.split(" ") if w] + [None]


def check_base(found, rows, held):
    known = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, kinds = sum(known.values()), len(known)
    expected = Counter()
    for i, text in rows:
        own = tokens(text)
        score = sum(math.log10((known[t] + 0.5) / (n + 0.5 * (kinds + 1))) for t in own)
        expected[i, held(i), len(own), sum(t in known for t in own), n, round(score, 6)] += 1
    assert Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found
    ) == expected


def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op4_hidden_markov_scores"](spark, folder).collect()
    check_base(found, [tuple(r) for r in rows], lambda i: zlib.crc32(str(i).encode()) % 5 == 1)
    held = [r for r in found if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_score_is_the_probability_in_the_model(spark):
    rows = [(i, "the cat sat" if i % 2 else "le chat ici " * (i % 5)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    blocks = hm.encoded(docs, F.lit(False), block_bytes=50).cache()
    corpus = hm._corpus_counts(blocks).cache()
    model = hm.train(blocks, corpus, states=2, rounds=2)
    found = {r.doc_id: r.score for r in hm.score(blocks, corpus, model).collect()}
    known = Counter(w for _, t in rows for w in hm.tokens_of(t.encode()))
    for i, text in rows[:4]:
        words = hm.tokens_of(text.encode())
        classes = [hm._hash(w) % hm.CLASSES for w in words]
        p = math.log10(sum(p for _, p in paths(classes, model)))
        for w, c in zip(words, classes):
            same = [n for o, n in known.items() if hm._hash(o) % hm.CLASSES == c]
            p += math.log10((known[w] + 0.5) / (sum(same) + 0.5 * (len(same) + 1)))
        assert found[i] == pytest.approx(p, rel=1e-6)
    for total in (model.start.sum(), *model.moves.sum(axis=1), *model.emits.sum(axis=0)):
        assert total == pytest.approx(1)


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (2, " \n"), (3, "A a\xa0b A"), (3, "A a\xa0b A"), (4, "x" * 200_000),
            (5, "long one " * 20_000), (None, "le le"), (6, "unseen")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id int, text string, lengths string")
    held = lambda i: i == 6
    found = hm.hidden_markov_scores(docs, F.col("doc_id") == 6, states=3, rounds=2).collect()
    check_base(found, rows, held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert hm.hidden_markov_scores(docs.limit(0), F.lit(True)).count() == 0
    nothing = hm.hidden_markov_scores(docs, F.lit(True), states=2, rounds=1).collect()
    assert len(nothing) == len(rows) and all(r.n_known == 0 for r in nothing)
