"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.plans import shipped as shipped


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of one data folder, by Spark's reader."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text modulo ``by``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % by


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 texts of an Arrow column; null is the empty text.

    A few at a time, so that a batch of long texts is not held twice.
    """
    for at in range(0, len(column), 256):
        for text in column.slice(at, 256).cast(pa.binary()).to_pylist():
            yield text or b""


def by_bytes(texts: Iterable[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of successive texts with about ``most`` bytes, one text at least."""
    start = size = 0
    end = -1
    for end, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, end
            start, size = end, 0
        size += len(text)
    if end >= start:
        yield start, end + 1
