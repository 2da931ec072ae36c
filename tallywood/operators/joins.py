"""Joins.

None of these names a join strategy: Spark broadcasts a side whose size it has
measured to be small, and at run time splits the skewed partitions of a shuffled
join by blocks of rows, equal rows too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.plans import number_rows


def join_multiplicity(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows per key of the inner join of two tables with repeated keys.

    Both sides are counted first, so the join has one row per key and the
    pairs it stands for are never made.
    """
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("_a"))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("_b"))
    return a.join(b, key).select(key, (F.col("_a") * F.col("_b")).alias("n"))


def resolve_alias(
    df: DataFrame, column: str, aliases: DataFrame, source: str, target: str
) -> DataFrame:
    """Replace ids that have an alias; ``aliases`` has one row per ``source``."""
    lookup = aliases.select(F.col(source).alias(column), F.col(target).alias("_target"))
    joined = df.join(lookup, column, "left")
    resolved = F.coalesce(F.col("_target"), F.col(column)).alias(column)
    return joined.select(*[resolved if c == column else F.col(c) for c in df.columns])


def keep_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``known``."""
    return df.join(known.select(key), key, "left_semi")


def drop_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``known``."""
    return df.join(known.select(key), key, "left_anti")


def zip_rows(**columns: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Pair up columns of several tables by position, from 0.

    Takes ``name=(table, order)``; the table has the column ``name`` and
    ``order`` is a total order of its rows. Tables of different lengths fail,
    as zipping does.
    """
    out = None
    for name, (frame, order) in columns.items():
        numbered = number_rows(frame, order, "idx").select(
            "idx", name, F.lit(True).alias(f"_has_{name}")
        )
        out = numbered if out is None else out.join(numbered, "idx", "full_outer")
    complete = F.lit(True)
    for name in columns:
        complete = complete & F.col(f"_has_{name}").isNotNull()
    failure = F.raise_error(F.lit("zipped tables differ in length")).cast("bigint")
    return out.select(F.when(complete, F.col("idx")).otherwise(failure).alias("idx"), *columns)
