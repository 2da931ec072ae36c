from __future__ import annotations

import random

import numpy as np
import xxhash

from tallywood.llm import golay, simhash
from tallywood.llm.components import connected_components
from tallywood.llm.queries import QUERIES


def plain_fingerprint(text: str) -> int:
    words, word = [], b""
    for c in text.encode():
        if c in b"\x20\x09\x0a\x0b\x0c\x0d":
            words += [word] if word else []
            word = b""
        else:
            word += bytes([c + 32]) if 65 <= c <= 90 else bytes([c])
    words += [word] if word else []
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(fps: list[int], ids: list) -> list:
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(fps))]


def test_codewords_are_seven_apart_and_neighbours_share_a_key():
    indices = golay.decode(np.arange(1 << 16))
    assert indices.min() >= 0 and indices.max() < 4096
    assert len(set(golay._leaders().tolist())) == 2048
    starts, values = golay.near_keys()
    own = golay.own_keys()
    rng = np.random.default_rng(0)
    for word in rng.integers(0, 1 << 16, 200):
        keys = set(values[starts[word] : starts[word + 1]].tolist())
        for other in [word, *(word ^ (1 << i) for i in range(16))]:
            assert own[other] in keys


def test_query_matches_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text or "") for r in rows]
    expected = {
        (r.doc_id, f"{f:016x}", c)
        for r, f, c in zip(rows, fps, plain_components(fps, [r.doc_id for r in rows]))
    }
    found = QUERIES["op3_simhash_near_duplicates"](spark, folder).collect()
    assert len(found) == len(rows)
    assert {tuple(r) for r in found} == expected


def test_all_close_pairs_are_found(spark):
    rng = random.Random(5)
    fps = []
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(6):
            flipped = base
            for _ in range(rng.randint(0, 5)):
                flipped ^= 1 << rng.randrange(64)
            fps.append(flipped)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    expected = {
        frozenset((signed[i], signed[j]))
        for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3
    }
    frame = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    for wide in (4096, 0):  # 0: every key is refined
        links = simhash.fingerprint_links(frame, wide_key=wide).collect()
        assert {frozenset((r.low, r.high)) for r in links} == expected


def test_odd_rows(spark):
    rows = [
        (None, None, 1), (3, "", 2), (1, " \t\n", 3), (7, "One two", 4), (7, "One two", 4),
        (9, "ONE  two", 5), (4, "x" * 300_000, 6), (5, "w " * 150_000, 7), (None, "alone here now", 8),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp int")
    found = simhash.simhash_components(docs).collect()
    expected = [plain_fingerprint(r[1] or "") for r in rows]
    groups = plain_components(expected, [r[0] for r in rows])
    assert len(found) == len(rows)
    key = lambda r: tuple((x is None, x) for x in r)
    signed = [f - (1 << 64) if f >> 63 else f for f in expected]
    assert sorted([tuple(r) for r in found], key=key) == sorted(
        [(r[0], f, c) for r, f, c in zip(rows, signed, groups)], key=key
    )
    assert simhash.simhash_components(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 260)] + [(8, 8)]
    frame = spark.createDataFrame(edges, "u bigint, v bigint")
    found = {r.vertex: r.component for r in connected_components(frame).collect()}
    assert {found[i] for i in range(100, 141)} == {100}
    assert {found[i] for i in [5, *range(200, 260)]} == {5}
    assert 8 not in found
