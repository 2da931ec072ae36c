"""Key-value operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.functions import suffixed
from tallywood.functions.text import WHITE_SPACE
from tallywood.operators.groups import count_by
from tallywood.plans import materialized, number_within, running_sums
from tallywood.plans.skew import HEAVY_ROWS


def count_words(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of every word, cut at white space."""
    every = df.select(F.explode(F.split(F.col(text), WHITE_SPACE)).alias("word"))
    return count_by(every.where(F.col("word") != ""), "word")


def sum_by_key(df: DataFrame, key: str, value: Column, name: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(name))


def partitioned_sum(
    df: DataFrame, key: str, value: str, partitions: int, name: str = "total"
) -> DataFrame:
    """Sum per key, laid out in ``partitions`` hash partitions of the key.

    The sums are laid out rather than the rows: same result, but a hot key is
    one row by then.
    """
    return df.groupBy(key).agg(F.sum(value).alias(name)).repartition(partitions, key)


def fold_by_key(df: DataFrame, key: str, value: str, start: int, name: str = "total") -> DataFrame:
    """Sum per key with a start value that counts once per key."""
    return df.groupBy(key).agg((F.sum(value) + F.lit(start)).alias(name))


def average_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum, count and average per key."""
    out = df.groupBy(key).agg(F.sum(value).alias("total"), F.count(value).alias("n"))
    return out.withColumn("average", F.col("total") / F.col("n"))


def with_unique_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Ids that are unique but neither consecutive nor kept if rows move."""
    return df.withColumn(name, F.monotonically_increasing_id())


def map_values(df: DataFrame, value: str, suffix: str = "_") -> DataFrame:
    """Values with a suffix; keys stay."""
    return df.withColumn(value, suffixed(F.col(value), suffix))


def ordered_values(
    df: DataFrame, key: str, value: str, min_rows: int = HEAVY_ROWS
) -> DataFrame:
    """The values of each key in order: ``(key, position, value, n)``.

    One row per distinct value, with the number of times it occurs and the position,
    from 0, of the first of them. Equal rows are counted before they are shuffled, so
    neither a key nor a value with any share of the rows is gathered anywhere.
    """
    counts = materialized(
        df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n")), "counted-values"
    )
    through = running_sums(counts, [value], {"_through": "n"}, [key], min_rows=min_rows)
    return through.select(key, (F.col("_through") - F.col("n")).alias("position"), value, "n")


def distinct_values(
    df: DataFrame, key: str, value: str, min_rows: int = HEAVY_ROWS
) -> DataFrame:
    """The distinct values of each key in order: ``(key, position, value)``, from 0."""
    distinct = materialized(df.select(key, value).distinct(), "distinct-values")
    return number_within(distinct, [key], [value], "position", min_rows=min_rows).select(
        key, "position", value
    )


def joined_text(
    values: DataFrame, key: str, value: str, separator: str, size: int, name: str = "joined"
) -> DataFrame:
    """Values with positions as text, ``size`` places to a row: ``(key, part, <name>)``.

    ``size`` is the caller's statement of how many values one text may hold; every key
    has its places 0 to size - 1 in part 0, the next ones in part 1, and so on. A value
    that occurs ``n`` times is repeated as often.
    """
    rows = values if "n" in values.columns else values.withColumn("n", F.lit(1).cast("bigint"))
    last = F.col("position") + F.col("n") - 1
    first_part, last_part = F.floor(F.col("position") / size), F.floor(last / size)
    parts = rows.withColumn("part", F.explode(F.sequence(first_part, last_part)))
    start = F.greatest(F.col("position"), F.col("part") * size)
    end = F.least(last, (F.col("part") + 1) * size - 1)
    runs = parts.select(
        key, "part", start.alias("_at"), (end - start + 1).cast("int").alias("_n"),
        F.col(value).cast("string").alias("_value"),
    )
    in_order = F.sort_array(F.collect_list(F.struct("_at", "_n", "_value")))
    repeated = F.flatten(F.transform(in_order, lambda r: F.array_repeat(r["_value"], r["_n"])))
    return runs.groupBy(key, "part").agg(F.concat_ws(separator, repeated).alias(name))


def words_by_frequency(word_counts: DataFrame, min_rows: int = HEAVY_ROWS) -> DataFrame:
    """Words that occur equally often, in order: ``(n, position, word)`` from ``(word, n)``."""
    return distinct_values(word_counts, "n", "word", min_rows)


def shared_frequencies(left: DataFrame, right: DataFrame) -> DataFrame:
    """All words of two tables whose frequency occurs in both: ``(n, side, position, word)``.

    ``left`` and ``right`` come from ``words_by_frequency``; ``side`` is ``left`` or
    ``right``. Every word of either side comes out once, so two large groups of one
    frequency do not multiply.
    """
    both = left.select("n").distinct().intersect(right.select("n"))
    sides = left.select("n", F.lit("left").alias("side"), "position", "word").unionAll(
        right.select("n", F.lit("right").alias("side"), "position", "word")
    )
    return sides.join(both, "n", "left_semi")
