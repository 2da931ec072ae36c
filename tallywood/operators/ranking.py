"""Top rows and thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, score: str, n: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the highest score; every task keeps its own ``n`` first."""
    return df.orderBy(F.desc(score), *tie_break).limit(n)


def nth_largest(df: DataFrame, value: str | Column, n: int, name: str = "threshold") -> DataFrame:
    """The ``n``-th largest value, or the least one of a shorter table."""
    column = F.col(value) if isinstance(value, str) else value
    largest = df.select(column.alias(name)).orderBy(F.desc(name)).limit(n)
    return largest.agg(F.min(name).alias(name))


def at_least_nth_largest(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows at or above the ``n``-th largest value, ties included."""
    threshold = nth_largest(df, value, n).scalar()
    return df.where(F.col(value) >= threshold)
