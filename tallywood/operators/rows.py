"""Row-wise operators: projection, cleaning, sampling and splitting."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(
    df: DataFrame, columns: Mapping[str, str | Column], casts: Mapping[str, str] | None = None
) -> DataFrame:
    """Select ``{output: input}`` and cast some outputs."""
    casts = casts or {}
    out = []
    for name, source in columns.items():
        value = F.col(source) if isinstance(source, str) else source
        out.append((value.cast(casts[name]) if name in casts else value).alias(name))
    return df.select(*out)


def select_by_name(
    df: DataFrame, keep: Callable[[str], bool], kind: str | None = None
) -> DataFrame:
    """Columns whose name passes a test, cast to one type."""
    chosen = [c for c in df.columns if keep(c)]
    return df.select(*[F.col(c).cast(kind).alias(c) if kind else F.col(c) for c in chosen])


def parse_or_drop(df: DataFrame, text: str, kind: str, name: str) -> DataFrame:
    """Rows whose text parses as ``kind``, with the value as ``name``."""
    parsed = df.withColumn(name, F.col(text).try_cast(kind))
    return parsed.where(F.col(name).isNotNull())


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, in one pass over the data."""
    return df.select(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )


def key_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 0
) -> list[DataFrame]:
    """Split rows at random by a hash of their keys.

    The parts are the same however the data is partitioned or recomputed, need
    neither a sort nor a cache, and keep equal keys together.
    """
    buckets = 1_000_000
    place = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(buckets))
    total = float(sum(weights))
    parts, low = [], 0.0
    for weight in weights:
        high = low + weight / total
        lo, hi = round(low * buckets), round(high * buckets)
        parts.append(df.where((place >= lo) & (place < hi)))
        low = high
    return parts


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's own weighted split, which sorts every partition to be repeatable."""
    return df.randomSplit([float(w) for w in weights], seed)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stratified_sample(
    df: DataFrame, column: str, fractions: Mapping[object, float], seed: int
) -> DataFrame:
    """Sample every class by its fraction; classes that are not named are dropped."""
    return df.sampleBy(column, dict(fractions), seed)


def stratified_step_sample(
    df: DataFrame, column: str, steps: Mapping[object, int], key: Column
) -> DataFrame:
    """Keep every ``steps[class]``-th key of a class, by arithmetic on the key."""
    keep = F.lit(False)
    for value, step in steps.items():
        keep = keep | ((F.col(column) == value) & (F.pmod(key, F.lit(step)) == 0))
    return df.where(keep)


def union_rows(left: DataFrame, right: DataFrame, drop_left: Sequence[str] = ()) -> DataFrame:
    """All rows of both, matched by column name, duplicates kept."""
    return left.drop(*drop_left).unionByName(right)
