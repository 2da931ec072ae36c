from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallywood.llm import packing
from tallywood.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return Tokenizer.from_file(PATH)


def expected_pieces(encoder, rows, capacity):
    made = Counter()
    for doc_id, text in rows:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], dtype="<u4")
            made[doc_id, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    return made


def check(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_query(spark, folder, encoder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op1_best_fit_packing"](spark, folder).collect()
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == expected_pieces(encoder, docs, 4096)
    bins = check(rows, 4096)
    assert bins <= -(-sum(r.length for r in rows) // 4096) + 1


def test_odd_rows(spark, encoder):
    texts = [
        None, "", " \n", "Hello, world. It's 1<|endoftext|>2 'tis", "a\x1cb\x85c d é.",
        "İstanbul ΣΑΣ ﬁne. Ⅷ, x.,y 12.", "w " * 9000, "x" * 3000, "same", "same", "é" * 200,
        "Ends. Here, now.", "don't. we'll, 'S", "a.b. c,,", "<|startoftext|> z",
    ]
    rows = [(None if i == 3 else i, t, "clash") for i, t in enumerate(texts)] + [(9, "same", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    packed = packing.pack(docs, PATH, capacity=64, keep_ids=True).collect()
    found = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert found == expected_pieces(encoder, [r[:2] for r in rows], 64)
    check(packed, 64)
    assert packing.pack(docs.limit(0), PATH).count() == 0


WORDS = st.text(alphabet="abzABZéÉßÄöñŒİıſŉΣσ.,'’1-\u0301\u00a0 \n日<|endoftext|>ª", max_size=14)


@settings(max_examples=600, deadline=None)
@given(WORDS)
def test_ids_are_those_of_the_tokenizer(text):
    encoder = packing.tokenizer(PATH)
    expected = np.array(encoder.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert packing.word_ids(PATH).text(text) == expected


def test_sequences_hold_the_ids(spark, encoder):
    docs = spark.createDataFrame([(i, f"word {i} " * (i % 7)) for i in range(60)], "doc_id int, text string")
    packed = packing.pack(docs, PATH, capacity=32, keep_ids=True)
    for r in packing.sequences(packed).collect():
        assert len(r.ids) == 4 * r.tokens <= 128
    total = sum(r.tokens for r in packing.sequences(packed).collect())
    assert total == sum(len(encoder.encode(f"word {i} " * (i % 7)).ids) + 1 for i in range(60))


def one_by_one(lengths, capacity):
    """The same rule, bin by bin over single pieces."""
    left, bins = sorted(lengths), []
    while left:
        held, gap = [], capacity
        for x in sorted(left, reverse=True):
            if x <= gap:
                held.append(x)
                gap -= x
        for x in held:
            left.remove(x)
        if gap and len(held) > 1:
            last = min(held)
            room = gap + last
            pairs = [(a + b, b) for i, a in enumerate(left) for b in left[i + 1 :] if a + b <= room]
            best = max(pairs, default=(0, 0))
            if best[0] > last:
                held.remove(last)
                left.append(last)
                for x in (best[1], best[0] - best[1]):
                    held.append(x)
                    left.remove(x)
                left.sort()
        bins.append(tuple(sorted(held)))
    return Counter(bins)


def test_best_two_fit_is_the_rule_of_single_bins():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.choice([10, 30, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        found = Counter()
        for pattern in packing.best_two_fit(Counter(lengths), capacity):
            held = tuple(sorted(x for x, n in pattern.copies.items() for _ in range(n)))
            found[held] += pattern.times
        assert found == one_by_one(lengths, capacity)


def test_replacement_saves_a_sequence():
    # Greedy: 6 + 3; with the pair: 6 + 2 + 2.
    patterns = packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    assert patterns[0].copies == {6: 1, 2: 2}
