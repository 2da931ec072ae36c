from __future__ import annotations

import random
import re

import pytest

from tallywood.llm import decontaminate

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(doc, items, window=10):
    words, hit, names = plain_words(doc), set(), set()
    for name, text in items:
        own = plain_words(text)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == own[i : i + n]:
                    hit |= set(range(j, j + n))
                    names.add("" if name is None else str(name))
    return len(words), len(hit), sorted(names)


def test_query(same_as_sql):
    same_as_sql("op7_benchmark_decontamination")


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_matches_brute_force(spark, block_bytes):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("ab") + rng.choice([" ", "-", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 6, 9]))) for i in range(8)] + [(None, "Été zwei"), (2, None), (2, "b b b")]
    docs = [(i, text(rng.randint(0, 40)), "x") for i in range(40)]
    docs += [(None, None, "y"), (50, "", "y"), (51, "ÉTÉ été, ZWEI!", "y"), (51, "ÉTÉ été, ZWEI!", "y"), (52, "a " * 30_000, "y")]
    frame = spark.createDataFrame(docs, "doc_id int, text string, n_hit string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    found = decontaminate.search(frame, bench, window=4, block_bytes=block_bytes).collect()
    got = {(r.row.doc_id, r.row.text): (r.n_words, r.n_hit, r["items"]) for r in found}
    assert len(found) == len(docs)
    for doc_id, content, _ in docs[:-1]:
        assert got[doc_id, content] == plain(content, items, 4)
    assert {r.row.n_hit for r in found if r.row.doc_id == 52} == {"y"}
    assert decontaminate.search(frame.limit(0), bench).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate.search(frame, bench.limit(0)).collect())


def test_windows_are_ten_words(spark):
    item = " ".join(f"w{i}" for i in range(14))
    docs = [(1, "x " + " ".join(f"W{i}" for i in range(2, 12)) + " y"), (2, " ".join(f"w{i}" for i in range(9)))]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    bench = spark.createDataFrame([(7, item)], "item_id int, text string")
    found = {r.row.doc_id: (r.n_hit, r["items"]) for r in decontaminate.search(frame, bench).collect()}
    assert found == {1: (10, ["7"]), 2: (0, [])}
