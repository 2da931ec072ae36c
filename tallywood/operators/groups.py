"""Group-wise operators.

Each one aggregates before it shuffles, so a key's rows reach the shuffle as
one partial row per task, however many of them there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Sums ``{output: column}`` per key, of the columns as they are.

    Money that must add up exactly comes as a decimal column.
    """
    return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def grouping_sets(
    df: DataFrame, sets: Sequence[Sequence[str]], sums: Mapping[str, str]
) -> DataFrame:
    """Sums ``{output: column}`` for every grouping set.

    Where one set has all the keys, rows are added up by them first: that
    shuffle is due anyway, and only its sums, not the rows, are then repeated
    per set. ``grouping_id`` tells a rolled-up null from a null in the data.
    """
    columns = list(dict.fromkeys(c for one in sets for c in one))
    added = {n: F.sum(c) for n, c in sums.items()}
    rows = df
    if any(set(one) == set(columns) for one in sets):
        rows = df.groupBy(*columns).agg(*[e.alias(n) for n, e in added.items()])
        added = {n: F.sum(n) for n in sums}
    return rows.groupingSets([[F.col(c) for c in one] for one in sets], *columns).agg(
        F.grouping_id().cast("long").alias("grouping_id"),
        *[e.alias(n) for n, e in added.items()],
    )


def class_totals(
    df: DataFrame, key: str, measures: Mapping[str, str], total: str = "total"
) -> DataFrame:
    """Sum of each measure and of all of them, largest total first."""
    sums = [F.sum(c) for c in measures.values()]
    whole = reduce(Column.__add__, sums)
    named = [s.alias(n) for n, s in zip(measures, sums, strict=True)]
    out = df.groupBy(key).agg(*named, whole.alias(total))
    return out.orderBy(F.desc(total), key)


def share_where(df: DataFrame, keys: Sequence[str], test: Column) -> DataFrame:
    """Rows, rows that pass a test (null counts as failed), and their ratio."""
    counted = df.groupBy(*keys).agg(
        F.sum(F.lit(1)).alias("total"),
        F.sum(F.when(test, 1).otherwise(0)).alias("correct"),
    )
    return counted.withColumn("ratio", F.col("correct") / F.col("total"))


def first_purchases(
    df: DataFrame, buyer: str, firsts: Mapping[str, str], test: Column, **constants: object
) -> DataFrame:
    """Smallest values per buyer over the rows that pass a test."""
    found = df.where(test).groupBy(buyer).agg(*[F.min(c).alias(n) for n, c in firsts.items()])
    return found.select("*", *[F.lit(v).alias(n) for n, v in constants.items()])


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Count matrix with a column per named value, zero where nothing is found."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0).orderBy(row)


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, least and greatest value per column.

    One pass for all columns. Numeric columns have their bounds as numbers,
    others as text.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for name in columns:
        numeric = isinstance(kinds[name], NumericType)
        number = F.col(name).cast("double") if numeric else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if numeric else F.col(name).cast("string")
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(name).alias("count"),
                F.avg(number).alias("mean"),
                F.stddev_samp(number).alias("stddev"),
                F.min(number).alias("min"),
                F.max(number).alias("max"),
                F.min(text).alias("min_text"),
                F.max(text).alias("max_text"),
            )
        )
    return df.agg(F.array(*rows).alias("profile")).select(F.inline("profile"))


def class_shares(df: DataFrame, key: str, name: str = "share") -> DataFrame:
    """Share of the rows per class."""
    counts = count_by(df, key)
    whole = counts.agg(F.sum("n")).scalar()
    return counts.select(key, "n", (F.col("n") / whole).alias(name))


def weighted_entropy(df: DataFrame, group: str, label: str) -> DataFrame:
    """Mean label entropy (natural log) of the groups, weighted by their size.

    With n rows per (group, label) and N per group, a group's size times its
    entropy is N ln N - sum(n ln n), so two counts are all it takes.
    """
    cells = count_by(df, group, label)
    groups = cells.groupBy(group).agg(
        F.sum("n").alias("size"), F.sum(F.col("n") * F.ln("n")).alias("inner")
    )
    weighted = F.col("size") * F.ln("size") - F.col("inner")
    return groups.agg((F.sum(weighted) / F.sum("size")).alias("entropy"))
