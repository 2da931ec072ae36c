from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tallywood.llm import token_groups as op
from tallywood.llm.queries import QUERIES

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_set(text: str | None) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in WHITE else c for c in lower).split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def plain_components(rows: list[tuple]) -> list[tuple]:
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict = {}
    for i, s in enumerate(sets):
        if s:
            parent[i] = root(first.setdefault(s, i))
    unique = list(first.values())
    for x, i in enumerate(unique):
        for j in unique[:x]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 85 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def same(found, rows) -> None:
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(plain_components(rows), key=key)


def families(seed: int, sizes: list[int], words: int, most_edits: int) -> list[tuple]:
    """Families of copies with some words of each replaced."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    rows = []
    for size in sizes:
        base = [word() for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, most_edits)):
                at = rng.randrange(len(text))
                text[at : at + rng.randint(0, 2)] = [word()]
            rows.append((len(rows) * 7 % 10007, " ".join(text)))
    rng.shuffle(rows)
    return rows


def test_query_matches_sql(same_as_sql):
    same_as_sql("op12_shingle_groups")


def test_query_matches_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    same(QUERIES["op12_shingle_groups"](spark, folder).collect(), rows)


@pytest.mark.parametrize("sizes,words,edits", [([120, 60, 3, 2, 1, 1], 100, 5), ([2] * 60, 30, 2)])
def test_families_of_copies(spark, monkeypatch, sizes, words, edits):
    rows = families(len(sizes), sizes, words, edits)
    monkeypatch.setattr(op, "GROUP_TOKENS", 400)
    monkeypatch.setattr(op, "QUERY_TOKENS", 900)
    for sampled in (8000, 5):  # with and without knowledge of frequent tokens
        monkeypatch.setattr(op, "SAMPLE_DOCS", sampled)
        same(op.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), rows)


def test_all_links_go_through_the_groups(spark, monkeypatch):
    """Without the comparison with leading holders the matrix finds every link."""
    rows = families(3, [40, 30, 2, 2, 1], 60, 3)
    empty = spark.createDataFrame([], "gid bigint, cid bigint, comp bigint")
    monkeypatch.setattr(op, "_leading", lambda shared, percent: (empty, empty))
    monkeypatch.setattr(op, "GROUP_TOKENS", 300)
    same(op.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), rows)


def test_a_common_passage_links_nothing(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    passage = " ".join(word() for _ in range(120))
    rows = [(i, passage + " " + " ".join(word() for _ in range(60))) for i in range(300)]
    found = op.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(i, i) for i in range(300)]


def test_groups_that_cannot_qualify_are_not_opened(monkeypatch):
    def frame(sets):
        return pa.table({
            "cid": list(range(len(sets))), "comp": list(range(len(sets))),
            "tokens": pa.array([sorted(s) for s in sets], pa.list_(pa.int64())),
        })

    members = frame([set(range(100)), set(range(50, 150))])
    far, near = set(range(85)) | set(range(900, 916)), set(range(2, 100))
    counted = []
    plain = np.bincount
    monkeypatch.setattr(op.np, "bincount", lambda *a, **k: counted.append(1) or plain(*a, **k))
    assert op.open_group(frame([far]), members, 85) == [] and not counted
    tables = frame([far, near]).set_column(1, "comp", pa.array([100, 101]))
    assert op.open_group(tables, members, 85) == [(1, 0)] and len(counted) == 1


def test_sketches_keep_every_link(spark):
    """Sketches differ in no more bits than sets in tokens; what they drop has no link."""
    rng = np.random.default_rng(5)
    base = [rng.integers(-(2**62), 2**62, n) for n in (1, 20, 60, 70, 500, 1030)]
    sets = [np.unique(b) for b in base]
    for b in base[1:]:
        for share in (0.01, 0.05, 0.08, 0.1, 0.3, 0.6):
            keep = b[rng.random(len(b)) > share]
            more = rng.integers(-(2**62), 2**62, rng.integers(0, 1 + int(share * len(b))))
            sets.append(np.unique(np.concatenate([keep, more])))

    def frame(first, sets):
        return pa.table({
            "comp": [first + i for i in range(len(sets))], "n": [len(x) for x in sets],
            "sketch": pa.array([op.set_sketch(x) for x in sets], pa.binary()),
        })

    dropped = 0
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            common = len(np.intersect1d(x, y))
            links = 100 * common >= 85 * (len(x) + len(y) - common)
            left, right = op.sift_group(frame(0, [x]), frame(100, [y]), 85)
            assert left.tolist() == right.tolist() and (left[0] or not links), (i, j)
            dropped += not left[0]
            assert not op.sift_group(frame(0, [x]), frame(0, [y]), 85)[0].any()
    assert dropped > 0.7 * len(sets) ** 2
    left, right = op.sift_group(frame(0, sets), frame(100, sets), 85)
    assert left.all() and right.all()


def test_no_text_is_read_for_documents_that_share_a_passage(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    passage = " ".join(word() for _ in range(120))
    rows = [(i, passage + " " + " ".join(word() for _ in range(100))) for i in range(60)]
    rows += [(100 + i, rows[7][1] + " end" * i) for i in range(1, 4)]
    monkeypatch.setattr(op, "SAMPLE_DOCS", 1)
    monkeypatch.setattr(op, "SAMPLE_SHARE", 0.0)
    asked, plain = [], op._texts
    monkeypatch.setattr(op, "_texts", lambda *a: asked.append(a[2].distinct().count()) or plain(*a))
    same(op.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), rows)
    assert 2 <= sum(asked) <= 8


def test_a_document_meets_a_group_once_a_token(spark):
    """However many components the members of a group are of."""
    rows = [(1, g, 100 * g + i, 100 * g + i, 100, 10_000, 0) for g in range(3) for i in range(40)]
    frame = spark.createDataFrame(
        rows, "token bigint, gid bigint, cid bigint, comp bigint, n int, reach bigint, main bigint"
    )
    met = op._meetings(frame, 85)
    assert met.count() <= 3 * 119
    assert {tuple(r) for r in met.collect()} >= {(c, c, 0) for _, _, c, *_ in rows if c}


def test_copies_far_from_all_others_ask_few_groups(spark, monkeypatch):
    """What a family of near copies asks grows with its size, not with the square."""
    met, plain = [], op._meetings
    monkeypatch.setattr(op, "_meetings", lambda *a: met.append(plain(*a).count()) or plain(*a))
    monkeypatch.setattr(op, "GROUP_TOKENS", 2000)
    for size in (250, 500):
        rows = families(size, [size], 150, 9)
        same(op.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), rows)
    assert met[0] < 3 * 250 and met[1] < 3 * 500, met


def test_texts_are_kept_by_a_bitmap(spark):
    docs = spark.createDataFrame([(i if i else None, str(i)) for i in range(3000)], "doc_id bigint, text string")
    ids = spark.createDataFrame([(i,) for i in (None, -5, 7, 2999)], "w bigint")
    found = {r.text for r in op._perhaps_in(docs, ids).collect()}
    assert {"0", "7", "2999"} <= found and len(found) < 10


def test_odd_rows(spark):
    rows = [
        (None, None), (3, ""), (1, " \t\n"), (7, "One two"), (7, "One two"), (9, "ONE  two"),
        (4, "x" * 300_000), (5, "w " * 150_000), (6, "w w w w"), (None, "alone here now then"),
        (11, " ".join(map(str, range(30_000)))), (2, " ".join(map(str, range(29_990)))),
        (12, "a b c d e"), (13, "a b c d f"), (14, "É b c d"), (15, "é b c d"), (3, ""),
        (None, "one two"), (16, "one two three"),
    ]
    wide = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id bigint, text string, sid string, n int")
    same(op.similar_documents(wide).collect(), rows)
    assert op.similar_documents(wide.limit(0)).count() == 0
    assert op.similar_documents(wide.where("text IS NULL")).count() == 1
