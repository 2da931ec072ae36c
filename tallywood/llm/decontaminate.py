"""Benchmark passages in documents, by Wu-Manber search over words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.llm.frames import texts_of
from tallywood.plans.scratch import materialized

WINDOW = 10
# Benchmark text that is searched for in one pass, and that a task holds.
BLOCK_BYTES = 32 << 20

# A-Z become a-z; every byte but letters, digits and those above 0x7F ends a word.
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class WuManber:
    """Search for word sequences of one length.

    ``shift`` says by the last two words of a place how far the next possible place
    is; where it is zero, patterns with those last words and the same first words are
    compared one by one. Patterns of one word have blocks of one word.
    """

    def __init__(self, patterns: dict[tuple[bytes, ...], frozenset[str]], length: int):
        self.length = length
        self.block = min(2, length)
        self.skip = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                at = pattern[end - self.block : end]
                self.shift[at] = min(self.shift.get(at, self.skip), length - end)
            last, first = pattern[-self.block :], pattern[: self.block]
            same_end = self.buckets.setdefault(last, {})
            same_end.setdefault(first, []).append((list(pattern), items))

    def search(self, words: Sequence[bytes]) -> Iterator[tuple[int, frozenset[str]]]:
        """(start, items) of every occurrence."""
        length, shift, skip = self.length, self.shift, self.skip
        pair = self.block == 2
        end, n = length - 1, len(words)
        while end < n:
            last = (words[end - 1], words[end]) if pair else (words[end],)
            step = shift.get(last, skip)
            if step:
                end += step
                continue
            start = end - length + 1
            first = tuple(words[start : start + self.block])
            for pattern, items in self.buckets[last].get(first, ()):
                if words[start : end + 1] == pattern:
                    yield start, items
            end += 1


def matchers(items: Sequence[tuple[str, bytes]], window: int = WINDOW) -> list[WuManber]:
    """One search for each length of windows: ``window``, and those of shorter items."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for name, text in items:
        words = words_of(text)
        length = min(window, len(words))
        if length:
            patterns = by_length.setdefault(length, {})
            for i in range(len(words) - length + 1):
                patterns.setdefault(tuple(words[i : i + length]), set()).add(name)
    return [
        WuManber({p: frozenset(names) for p, names in patterns.items()}, length)
        for length, patterns in sorted(by_length.items())
    ]


@lru_cache(maxsize=2)
def _matchers_of(items: tuple[tuple[str, bytes], ...], window: int) -> list[WuManber]:
    return matchers(items, window)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[tuple[str, bytes], ...]]:
    """The items in groups of about ``block_bytes`` of text; one empty group if none."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    block = F.pmod(F.xxhash64("name", "text"), F.lit(n))
    for b in range(n):
        rows = items.where(block == b).collect()
        yield tuple(sorted((r["name"], r["text"].encode()) for r in rows))


def search(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Every row of ``docs`` as ``row`` (a struct of all its columns), with what is in it.

    Added: n_words, n_hit (words inside any occurrence of a window), items (sorted ids
    of the benchmark items with occurring windows, as text). A window is ``window``
    successive words of an item, or the whole of a shorter one; items without words
    have none. Columns used: ``text`` of docs, ``item_id`` and ``text`` of benchmark.

    Each task searches whole texts with its own tables, so no document is shuffled.
    The benchmark is a stated set of strings; it goes to the tasks in blocks of
    ``block_bytes`` of text, each block after the first in a pass over rows that
    are written to the shared folder, so what a task holds does not grow with it.

    Null text: no words. A null item_id is the empty name; repeated items count once.
    Ids of documents are not looked at; repeated rows come out as often; no documents
    give no rows, no items no hits.
    """
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    state = docs.select(
        columns.alias("row"), "text", F.lit(0).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_hit"), F.lit(None).cast("binary").alias("hit"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    for n, items in enumerate(_blocks(benchmark, block_bytes)):
        state = (materialized(state, "searched") if n else state).mapInArrow(
            _searcher(items, window), state.schema
        )
    return state.select("row", "n_words", "n_hit", "items")


def _searcher(items: tuple[tuple[str, bytes], ...], window: int):
    """Adds one block of items to what is known of each row; ``hit`` marks words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _matchers_of(items, window)
        for batch in batches:
            n_words, n_hit, hits, names = [], [], [], []
            before = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            for text, (mask, known) in zip(texts_of(batch.column(1)), before):
                words = words_of(text)
                found = set(known or ())
                marks = np.frombuffer(mask, np.uint8).copy() if mask else None
                for one in searches:
                    for start, its in one.search(words):
                        if marks is None:
                            marks = np.zeros(len(words), np.uint8)
                        marks[start : start + one.length] = 1
                        found |= its
                n_words.append(len(words))
                n_hit.append(0 if marks is None else int(marks.sum()))
                hits.append(None if marks is None else marks.tobytes())
                names.append(sorted(found))
            added = [
                pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(hits, pa.binary()), pa.array(names, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *added], batch.schema.names
            )

    return run


def digest(names: str) -> Column:
    """sha256 of the names, comma-joined, as lowercase hex."""
    return F.sha2(F.array_join(names, ","), 256)
