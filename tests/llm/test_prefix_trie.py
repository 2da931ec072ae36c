from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tallywood.llm import prefix_trie as op
from tallywood.llm.queries import QUERIES


def plain_trie(convs: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """Nodes of rebuilt conversations, from a dictionary of all prefixes."""
    members: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children: dict[tuple, int] = {}
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(own) - 1) * words
    return sorted(
        (min(own), len(path), min(members[path[:-1]]) if path else None, len(own),
         children.get(path, 0), leaves[path], saved[path],
         hashlib.sha256(",".join(str(c) for c in sorted(own) if len(convs[c]) == len(path)).encode()).hexdigest())
        for path, own in members.items()
    )


def plain_rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns, key=lambda x: x[0])] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def found(frame) -> list[tuple]:
    return sorted(map(tuple, frame.collect()))


def test_query_matches_sql(same_as_sql):
    same_as_sql("op13_conversation_trie")


@pytest.mark.parametrize("per_shard", [3, 40, 10**6])
def test_query_matches_brute_force_for_any_shards(spark, folder, monkeypatch, per_shard):
    monkeypatch.setattr(op, "SHARD_TURNS", per_shard)
    monkeypatch.setattr(op, "COLUMNS", 3)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_conversation_trie"](spark, folder)) == plain_trie(plain_rebuilt(rows))


@pytest.mark.parametrize("seed", range(4))
def test_deep_and_repeated_sequences(spark, monkeypatch, seed):
    monkeypatch.setattr(op, "SHARD_TURNS", 25)
    monkeypatch.setattr(op, "COLUMNS", 2)
    rng = random.Random(seed)
    convs = {}
    for c in rng.sample(range(-200, 1000), 120):
        kind = rng.random()
        turns = [("u", "a b"), ("v", "")] * 9 if kind < 0.3 else [
            (rng.choice("uv"), rng.choice(["x", "y z"])) for _ in range(rng.randint(0, 6))
        ]
        convs[c] = turns[: rng.randint(0, len(turns))] if kind < 0.1 else turns
    rows = [
        (c, [hash(t) % 10**9 - 10**8 for t in turns], [len(t[1].split()) for t in turns]) for c, turns in convs.items()
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, ids array<bigint>, words array<int>")
    assert found(op.trie_nodes(frame)) == plain_trie(convs)


def test_odd_rows(spark):
    rows = [
        (0, 2, "user", "one two"), (0, None, None, "first  \t here"), (0, 3, "user", None),
        (1, 1, "user", "x"), (4, 1, "a", "b"), (21, 1, "a", ""), (21, 2, "a", ""), (21, 2, "a", ""),
        (40, 5, "", None), (41, 5, None, ""), (-3, 1, "user", "neg"), (None, 1, "user", "nobody"),
        (7, 1, "long", "w " * 100_000), (7, 2, "u", "t"), (7, 3, "u", "t"), (7, 4, "u", "t"),
        (20_000_000_000, 1, "user", "far"),
    ]
    wide = spark.createDataFrame([(*r, "k", 5) for r in rows], SCHEMA + ", ids string, depth int")
    assert found(op.conversation_trie(wide)) == plain_trie(plain_rebuilt(rows))
    assert op.conversation_trie(wide.limit(0)).count() == 0
    assert op.conversation_trie(wide.where("conv_id IS NULL")).count() == 0


def test_one_huge_group(spark, monkeypatch):
    monkeypatch.setattr(op, "SHARD_TURNS", 500)
    same = [(20 * c, t, "user", f"turn {t}") for c in range(400) for t in range(3)]
    long = [(20 * c + 7, t, "u", str(t % 5)) for c in (1, 2) for t in range(900)]
    frame = spark.createDataFrame(same + long, SCHEMA)
    assert found(op.conversation_trie(frame)) == plain_trie(plain_rebuilt(same + long))
