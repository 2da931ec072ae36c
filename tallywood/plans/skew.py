"""Hot keys of ordered scans. Joins leave them to Spark, which splits them at run time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with fewer rows than this is sorted or joined by one task without harm.
HEAVY_ROWS = 5_000_000
# Rows of a heavy key that suffice to tell it from others by a sample.
SAMPLED_ROWS = 1000
# A heavy key holds at least this share of all rows, so there are at most 10,000 of
# them whatever the data size, and no other key is a larger part of a task's work
# than one of 10,000 partitions.
HEAVY_SHARE = 1e-4


@dataclass(frozen=True)
class HeavyKeys:
    """Heavy keys with their row counts ``_n``, as a small local table."""

    frame: DataFrame
    keys: tuple[str, ...]
    rows: int
    min_rows: int


def find_heavy(
    df: DataFrame, keys: Sequence[str], min_rows: int = HEAVY_ROWS
) -> HeavyKeys | None:
    """Keys with about ``min_rows`` rows or more, or None.

    One pass over the key columns. It counts a sample in which such a key still
    has ``SAMPLED_ROWS`` rows, so that next to nothing is shuffled. The counts
    only decide how work is split up; no result depends on them.
    """
    fraction = min(1.0, SAMPLED_ROWS / min_rows)
    rows = df.select(*keys)
    if fraction < 1:
        rows = rows.sample(withReplacement=False, fraction=fraction, seed=0)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sampled"))
    # Lets keys at the limit pass whose sample came out somewhat small.
    slack = 0.9 if fraction < 1 else 1.0
    estimate = F.ceil(F.col("_sampled") / (fraction * slack)).alias("_n")
    return heavy_among(counts.select(*keys, estimate), keys, "_n", min_rows)


def heavy_among(
    counts: DataFrame, keys: Sequence[str], count: str, min_rows: int = HEAVY_ROWS
) -> HeavyKeys | None:
    """Like ``find_heavy``, from counts per key that are there already.

    The heavy keys, which ``HEAVY_SHARE`` bounds in number, come to the driver; held
    there, every later use sees the same ones.
    """
    whole = counts.agg(F.sum(count)).head()[0] or 0
    least = max(min_rows, whole * HEAVY_SHARE)
    largest = counts.select(*keys, F.col(count).cast("bigint").alias("_n")).where(
        F.col("_n") >= least
    )
    rows = largest.collect()
    if not rows:
        return None
    frame = counts.sparkSession.createDataFrame(rows, largest.schema)
    return HeavyKeys(frame, tuple(keys), sum(r["_n"] for r in rows), min_rows)


def mark_heavy(df: DataFrame, heavy: HeavyKeys) -> DataFrame:
    """Add ``_n``: the row count of a heavy key, null for any other key."""
    flags = heavy.frame.toDF(*[f"_heavy_{k}" for k in heavy.keys], "_n")
    same = reduce(
        Column.__and__, [df[k].eqNullSafe(flags[f"_heavy_{k}"]) for k in heavy.keys]
    )
    marked = df.join(F.broadcast(flags), same, "left")
    return marked.drop(*[f"_heavy_{k}" for k in heavy.keys])
