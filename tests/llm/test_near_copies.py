from __future__ import annotations

from collections import Counter

from tallywood.llm.near_copies import one_of_each
from tests.llm.test_simhash import plain_components, plain_fingerprint


def expected(rows: list[tuple]) -> Counter:
    """Of each group the first row by null id, id and then all columns."""
    groups = plain_components([plain_fingerprint(r[1] or "") for r in rows], list(range(len(rows))))
    best: dict = {}
    for group, row in zip(groups, rows):
        order = (row[0] is None, row[0] or 0, tuple((x is not None, x) for x in row))
        if group not in best or order < best[group][0]:
            best[group] = order, row
    return Counter(row for _, row in best.values())


def test_one_row_of_each_group_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = one_of_each(docs)
    assert found.dtypes == docs.dtypes
    assert Counter(map(tuple, found.collect())) == expected([tuple(r) for r in docs.collect()])


def test_odd_rows(spark):
    rows = [
        (5, "one two three four", 3, "a"), (4, "ONE two  three four", 2, "b"), (4, "ONE two  three four", 1, "b"),
        (None, "one two three four", 0, None), (9, None, 1, "c"), (8, "", 1, "c"), (7, " \t", 2, None),
        (None, "only without an id", 5, "d"), (None, "only without an id", 5, "d"), (1, "x" * 200_000, 1, "e"),
        (2, "w " * 100_000, 1, "e"), (3, "quite another text", 1, "f"), (3, "and one more of this id", 1, "f"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `key` int, `component.x` string")
    assert Counter(map(tuple, one_of_each(docs).collect())) == expected(rows)
    alone = docs.where("doc_id = 3")
    assert one_of_each(alone).count() == 2
    assert one_of_each(docs.limit(0)).count() == 0
    assert one_of_each(docs.limit(0)).dtypes == docs.dtypes
