from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tallywood.llm import decontaminate, packing
from tallywood.llm.queries import vocabulary


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, results[-1], folder).write.parquet(path)
        results.append(spark.read.parquet(path))
    return results


def test_filters_keep_columns_and_whole_rows(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.dtypes == before.dtypes
        rows = Counter(map(tuple, before.collect()))
        rows.subtract(map(tuple, after.collect()))
        assert min(rows.values()) >= 0


def test_toxic_documents_go(stages, spark, folder):
    toxic = dict(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").collect())
    kept = {r.doc_id for r in stages[1].select("doc_id").collect()}
    clean = [d for d, t in toxic.items() if t == 0]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)


def test_copies_go(stages):
    def normal(r):
        return " ".join((r.text or "").lower().split())

    before = Counter(map(normal, stages[1].collect()))
    after = Counter(map(normal, stages[2].collect()))
    assert set(after.values()) == {1} and set(after) <= set(before)


def test_no_benchmark_words_are_left(stages, spark, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    windows = set()
    for r in items:
        words = decontaminate.words_of((r.text or "").encode())
        n = min(10, len(words))
        windows |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1 if n else 0)}
    lengths = {len(w) for w in windows}

    def clean(text):
        words = decontaminate.words_of((text or "").encode())
        return not any(tuple(words[i : i + n]) in windows for n in lengths for i in range(len(words)))

    before = {r.doc_id: clean(r.text) for r in stages[2].collect()}
    assert {r.doc_id for r in stages[3].collect()} == {d for d, ok in before.items() if ok}


def test_sequences_hold_every_document(stages, spark, folder):
    encoder = packing.word_ids(vocabulary("word_bpe_49k.json"))
    rows = stages[4].collect()
    tokens = Counter()
    for r in rows:
        tokens[r.doc_id] += r.length
    assert tokens == {r.doc_id: len(encoder.text(r.text or "")) // 4 + 1 for r in stages[3].collect()}
    whole = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.length) for r in whole) == Counter((r.doc_id, r.piece, r.length) for r in rows)


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
