"""Token counts of whole texts, by batches that return lengths only."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.frames import by_bytes
from tallywood.llm.words import Memory, tokenizer

# Bytes of texts that are split at a time, and of pieces in one call of the encoder.
TEXT_BYTES = 4 << 20
BATCH_BYTES = 256 << 10

# White space besides blank and line feed, of Unicode or of str.split.
_OTHER_SPACE = "\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(
    f"[ \\n]*[^ \\n]+(?:(?<=[{_OTHER_SPACE}])[ \\n]+[^ \\n]*)*|[ \\n]+"
)


def safe_pieces(text: str) -> list[str]:
    """Cut a text before each run of blanks or line feeds that follows a character
    other than white space.

    A byte-level vocabulary never joins such a character with white space after it
    and looks ahead no further, so the tokens of a text are those of its pieces.
    """
    return _PIECE.findall(text)


class _Lengths(Memory):
    def batch(self, path: str, texts: list[str]) -> list[int]:
        split = [safe_pieces(t) for t in texts]
        known: dict[str, int] = {}
        new = []
        for piece in set().union(*split):
            n = self.get(piece)
            if n is None and (n := self.old.get(piece)) is None:
                new.append(piece)
            else:
                known[piece] = n
        sizes = [p.encode() for p in new]
        encoder = tokenizer(path)
        for start, end in by_bytes(sizes, BATCH_BYTES):
            found = encoder.encode_batch_fast(new[start:end], add_special_tokens=False)
            known.update(zip(new[start:end], map(len, found)))
        for piece, n in known.items():
            if piece not in self:
                self.keep(piece, n)
        return [sum(map(known.__getitem__, pieces)) for pieces in split]


@cache
def _lengths(path: str) -> _Lengths:
    return _Lengths()


@cache
def _pieces_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def token_lengths(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text, without begin, end or added special tokens."""
    if path.endswith(".model"):
        return [len(x) for x in _pieces_model(path).encode(texts, num_threads=1)]
    return _lengths(path).batch(path, texts)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text).

    ``vocabulary``: the file of a byte-level tokenizer (.json) or of a sentencepiece
    model (.model), at one path on all machines. Nothing is shuffled. A task splits
    some megabytes of texts at a time at safe places, so that a very long text is
    encoded in small calls of about equal bytes; a piece that comes again is not
    encoded again. sentencepiece texts are encoded whole.

    Null text: empty, with no bytes or tokens. Null ids, repeated rows and other
    columns change nothing; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            raw = [len(t.encode()) for t in texts]
            n: list[int] = []
            start = size = 0
            for end, b in enumerate(raw):
                if size and size + b > TEXT_BYTES:
                    n += token_lengths(vocabulary, texts[start:end])
                    start, size = end, 0
                size += b
            n += token_lengths(vocabulary, texts[start:])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()), pa.array(raw, pa.int64()),
                    pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
