"""Packing documents into token sequences of fixed length, best-two-fit."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywood.llm.words import Memory, tokenizer
from tallywood.plans.scratch import materialized

CAPACITY = 4096
END = np.uint32(1).tobytes()

# White space for str.split but not for the tokenizer.
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Bytes that are printable in Latin-1 stand for themselves, the others for the
    characters from U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + n) for n, b in enumerate(others)}


class WordIds(Memory):
    """Little-endian ids of words, for a lower-casing tokenizer that drops white space.

    Words between white space are normalised and split on their own, so the ids of
    a text are those of its words one after another. A word of Latin letters is one
    piece for the tokenizer, which its vocabulary then splits directly; all others
    take the tokenizer's whole way.
    """

    def __init__(self, path: str):
        super().__init__()
        self.encoder = tokenizer(path)
        self.vocabulary = self.encoder.model
        self.letters = _byte_letters()
        self.mark = {m: self.whole(m) for m in ".,"}

    def value(self, piece: str) -> bytes:
        word = piece[:-1] if piece[-1] in ".," else piece
        # Latin letters below U+0250 are composed as they stand; only the dotted capital
        # I among them has no lower case of one letter.
        if not (word.isalpha() and max(word) < "\u0250" and "\u0130" not in word):
            return self.whole(piece)
        if word is not piece:
            # Letters and one mark: two pieces for the tokenizer as well.
            return self[word] + self.mark[piece[-1]]
        lower = word.lower()
        if not lower.isascii():
            lower = lower.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.vocabulary.tokenize(lower)]).tobytes()

    def whole(self, text: str) -> bytes:
        ids = self.encoder.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def text(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


PIECE = {
    "doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
    "ids_crc32": pa.int64(), "ids": pa.binary(), "task": pa.int32(), "place": pa.int64(),
}


def pieces(docs: DataFrame, vocabulary: str, capacity: int, keep_ids: bool) -> DataFrame:
    """One row for each piece of each document, nothing shuffled.

    ``place`` numbers the pieces of one length within the task ``task``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(vocabulary)
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.text(text or "") + END
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    length = len(part) // 4
                    rows.append((
                        doc_id, n, at // 4, length, zlib.crc32(part),
                        part if keep_ids else None, task, seen[length],
                    ))
                    seen[length] += 1
            columns = list(zip(*rows)) or [()] * len(PIECE)
            arrays = [pa.array(c, t) for c, t in zip(columns, PIECE.values())]
            yield pa.RecordBatch.from_arrays(arrays, list(PIECE))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(
        run,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "ids binary, task int, place bigint",
    )


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences that each hold ``copies[length]`` pieces of each length."""

    times: int
    copies: dict[int, int]


def _fill(left: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[dict[int, int], int]:
    """Greedily the longest piece that fits, again and again; and the gap that stays."""
    filled: dict[int, int] = {}
    gap, at = capacity, len(lengths) - 1
    while (at := min(at, int(np.searchsorted(lengths, gap, "right")) - 1)) >= 0:
        length = int(lengths[at])
        filled[length] = min(int(left[length]), gap // length)
        gap -= filled[length] * length
        at -= 1
    return filled, gap


def _best_pair(free: np.ndarray, room: int) -> tuple[int, int, int]:
    """(sum, longer, shorter) of the two free pieces that fill ``room`` best.

    Among equal sums the one with the longest piece.
    """
    lengths = np.flatnonzero(free[:room])
    if not len(lengths):
        return 0, 0, 0
    upto = np.zeros(room + 1, dtype=np.int64)
    upto[lengths] = lengths
    upto = np.maximum.accumulate(upto)  # the longest free piece of at most this length
    other = np.minimum(lengths, room - lengths)
    shorter = upto[other]
    twice = (shorter == lengths) & (free[lengths] < 2)
    shorter = np.where(twice, upto[np.maximum(other - 1, 0)], shorter)
    sums = np.where(shorter > 0, lengths + shorter, 0)
    at = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return int(sums[at]), int(lengths[at]), int(shorter[at])


def best_two_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Sequences for ``counts[length]`` pieces of each length.

    A sequence is filled greedily; if a gap stays and it holds two pieces or more,
    its shortest piece makes room for the two unpacked pieces that fill the gap and
    its place more tightly, if there are such. Sequences that come out alike in a
    row are one pattern, so the work follows the number of different lengths (at most
    ``capacity``) and not the number of documents.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    made = []
    while len(lengths := np.flatnonzero(left)):
        filled, gap = _fill(left, lengths, capacity)
        copies = dict(filled)
        if gap and sum(filled.values()) > 1:
            shortest = min(filled)
            free = left.copy()
            for length, n in filled.items():
                free[length] -= n
            best, longer, shorter = _best_pair(free, gap + shortest)
            if best > shortest:
                copies[shortest] -= 1
                copies[longer] = copies.get(longer, 0) + 1
                copies[shorter] = copies.get(shorter, 0) + 1
        copies = {length: n for length, n in copies.items() if n}
        times = min(
            (int(left[x]) - max(filled.get(x, 0), n)) // n + 1 for x, n in copies.items()
        )
        for length, n in copies.items():
            left[length] -= n * times
        made.append(Pattern(times, copies))
    return made


def _layout(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For runs of equally long pieces in number order: where they go, as sorted arrays."""
    runs, used, sequence = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length, n in sorted(pattern.copies.items(), reverse=True):
            first = used.get(length, 0)
            used[length] = first + n * pattern.times
            runs.append((length, first, pattern.times, sequence, offset))
            offset += n * length
        sequence += pattern.times
    columns = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "times", "sequence", "offset"), columns))


def _placed(rows: DataFrame, layout: dict[str, np.ndarray]) -> DataFrame:
    """Add sequence_id and offset by a piece's number among those of its length."""
    keys = (layout["length"] << 48) | layout["first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number")
            )
            at = np.searchsorted(keys, (length << 48) | number, "right") - 1
            copy, turn = np.divmod(number - layout["first"][at], layout["times"][at])
            added = [layout["sequence"][at] + turn, layout["offset"][at] + copy * length]
            kept = [batch.column(i) for i in range(6)]
            yield pa.RecordBatch.from_arrays(
                [*kept, *map(pa.array, added)],
                [*batch.schema.names[:6], "sequence_id", "offset"],
            )

    return rows.mapInArrow(
        run,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, "
        "sequence_id bigint, offset bigint",
    )


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, ids (little-endian
    unsigned 32-bit, null unless ``keep_ids``), sequence_id, offset. A document's ids
    end with id 1; only longer documents are cut. ``vocabulary`` is the file of a
    tokenizer that drops white space, at one path on all machines.

    The tokens are made in one pass and written to the shared folder with a number
    for each piece among those of its length and task. Only the histogram of lengths,
    at most ``capacity`` rows, comes to the driver, where best-two-fit packs it; the
    tasks then look up their pieces' places. No group of equal lengths is gathered.

    A null text is empty (one piece of one token); a null doc_id is packed like any
    other; repeated rows are packed as often as they occur; other columns are ignored;
    no rows give no rows.
    """
    made = materialized(pieces(docs, vocabulary, capacity, keep_ids), "pieces")
    per_task = made.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    per_task = materialized(per_task, "lengths")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = per_task.select(
        "task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    numbered = made.join(before, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids",
        (F.col("place") + F.col("before")).alias("number"),
    )
    return _placed(numbered, _layout(best_two_fit(counts, capacity)))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, tokens, pieces, ids) of a packing made with ``keep_ids``.

    One row holds at most one sequence, so the group is bounded by the capacity.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("pieces"), ordered.alias("_p")
    ).select(
        "sequence_id", "tokens", "pieces",
        F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
    )
