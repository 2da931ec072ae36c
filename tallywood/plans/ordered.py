"""Ordered scans (running sums, fills, row numbers) that do not depend on any
one task holding a whole group.

Rows of ordinary keys go through a plain window. Rows of heavy keys, or of the
whole table where there is no key, are ranged over the cluster and cut into
contiguous runs, one per range partition; each run is scanned on its own and
then gets the carry of the runs before it. The carry table has one row per run,
so it is bounded by the number of partitions plus the number of heavy keys.

The ranges are written out before their partition numbers are used: bounds are
sampled anew whenever ranges are planned, and rows and carries must agree.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywood.plans.scratch import materialized
from tallywood.plans.skew import HEAVY_ROWS, HeavyKeys, find_heavy, mark_heavy

# monotonically_increasing_id holds the partition above this bit and the
# position in the partition below it.
POSITION_BITS = 33

# Stands for heavy keys that are still to be found.
FIND = "find"

Order = str | Column


def ordered_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[Order], heavy: HeavyKeys | None
) -> tuple[DataFrame, bool]:
    """Add ``_run``: -1 for whole groups, else the number of a contiguous run.

    The flag tells whether any group was cut.
    """
    if not keys:
        sorted_rows = df.orderBy(*order).withColumn("_run", F.spark_partition_id())
        return materialized(sorted_rows, "runs"), True
    if heavy is None:
        return df.withColumn("_run", F.lit(-1)), False
    marked = mark_heavy(df, heavy)
    light = marked.where(F.col("_n").isNull()).drop("_n").withColumn("_run", F.lit(-1))
    hot = marked.where(F.col("_n").isNotNull()).drop("_n")
    n_runs = math.ceil(heavy.rows / heavy.min_rows)
    ranged = hot.repartitionByRange(n_runs, *keys, *order)
    cut = materialized(ranged.withColumn("_run", F.spark_partition_id()), "runs")
    return light.unionByName(cut), True


def _heavy(
    df: DataFrame, keys: Sequence[str], heavy: HeavyKeys | str | None, min_rows: int
) -> HeavyKeys | None:
    if heavy != FIND:
        return heavy
    return find_heavy(df, keys, min_rows) if keys else None


def _with_carry(
    scanned: DataFrame,
    run_values: DataFrame,
    keys: Sequence[str],
    carries: Mapping[str, Column],
) -> DataFrame:
    """Join the carry columns, given as expressions over earlier runs."""
    carry = run_values.select(
        *[F.col(k).alias(f"_carry_{k}") for k in keys],
        F.col("_run").alias("_carry_run"),
        *[expression.alias(name) for name, expression in carries.items()],
    )
    same = reduce(
        Column.__and__,
        [F.col(k).eqNullSafe(F.col(f"_carry_{k}")) for k in keys],
        F.col("_run") == F.col("_carry_run"),
    )
    joined = scanned.join(F.broadcast(carry), same, "left")
    return joined.drop(*[f"_carry_{k}" for k in keys], "_carry_run")


def _earlier_runs(keys: Sequence[str]):
    return (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy("_run")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def running_sums(
    df: DataFrame,
    order: Sequence[Order],
    sums: Mapping[str, Order],
    keys: Sequence[str] = (),
    heavy: HeavyKeys | str | None = FIND,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add running sums ``{output: expression}`` up to and including each row.

    ``order`` must be a total order within a key. Heavy keys are looked for,
    unless the caller knows them.
    """
    exprs = {name: F.col(e) if isinstance(e, str) else e for name, e in sums.items()}
    runs, cut = ordered_runs(df, keys, order, _heavy(df, keys, heavy, min_rows))
    so_far = (
        Window.partitionBy(*keys, "_run")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = runs.select("*", *[F.sum(e).over(so_far).alias(n) for n, e in exprs.items()])
    if not cut:
        return scanned.drop("_run")
    run_totals = (
        runs.where(F.col("_run") >= 0)
        .groupBy(*keys, "_run")
        .agg(*[F.sum(e).alias(n) for n, e in exprs.items()])
    )
    before = _earlier_runs(keys)
    carried = _with_carry(
        scanned, run_totals, keys, {f"_carry_of_{n}": F.sum(n).over(before) for n in exprs}
    )
    # A sum over nothing but nulls stays null, as in one window.
    both = {
        n: F.coalesce(
            F.col(n) + F.coalesce(F.col(f"_carry_of_{n}"), F.lit(0)), F.col(f"_carry_of_{n}")
        )
        for n in exprs
    }
    return carried.select(*df.columns, *[e.alias(n) for n, e in both.items()])


def running_first_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Mapping[str, str] | None = None,
    last: Mapping[str, str] | None = None,
    heavy: HeavyKeys | str | None = FIND,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add the first / last non-null value of a column up to each row.

    ``first`` and ``last`` map output names to input columns; ``order`` must be
    a total order within a key.
    """
    first, last = dict(first or {}), dict(last or {})
    runs, cut = ordered_runs(df, keys, order, _heavy(df, keys, heavy, min_rows))
    so_far = (
        Window.partitionBy(*keys, "_run")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = runs.select(
        "*",
        *[F.first(c, ignorenulls=True).over(so_far).alias(n) for n, c in first.items()],
        *[F.last(c, ignorenulls=True).over(so_far).alias(n) for n, c in last.items()],
    )
    if not cut:
        return scanned.drop("_run")

    place = F.struct(*order)

    def placed(column: str) -> Column:
        return F.when(F.col(column).isNotNull(), place)

    run_values = (
        runs.where(F.col("_run") >= 0)
        .groupBy(*keys, "_run")
        .agg(
            *[F.min_by(c, placed(c)).alias(n) for n, c in first.items()],
            *[F.max_by(c, placed(c)).alias(n) for n, c in last.items()],
        )
    )
    before = _earlier_runs(keys)
    carried = _with_carry(
        scanned,
        run_values,
        keys,
        {
            **{f"_carry_of_{n}": F.first(n, ignorenulls=True).over(before) for n in first},
            **{f"_carry_of_{n}": F.last(n, ignorenulls=True).over(before) for n in last},
        },
    )
    return carried.select(
        *df.columns,
        *[F.coalesce(F.col(f"_carry_of_{n}"), F.col(n)).alias(n) for n in first],
        *[F.coalesce(F.col(n), F.col(f"_carry_of_{n}")).alias(n) for n in last],
    )


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Order],
    name: str,
    heavy: HeavyKeys | str | None = FIND,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add the row's position in its group, from 0."""
    numbered = running_sums(df, order, {name: F.lit(1).cast("long")}, keys, heavy, min_rows)
    return numbered.withColumn(name, F.col(name) - 1)


def number_rows(df: DataFrame, order: Sequence[Order], name: str = "idx") -> DataFrame:
    """Add a consecutive index over the whole table, from 0.

    One distributed sort; the positions inside its partitions are shifted by
    the sizes of the partitions before them.
    """
    in_order = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialized(in_order, "placed")
    placed = placed.withColumn("_run", F.shiftright("_at", POSITION_BITS))
    sizes = placed.groupBy("_run").agg(F.count(F.lit(1)).alias("_size"))
    position = F.col("_at") - F.shiftleft("_run", POSITION_BITS)
    carried = _with_carry(
        placed, sizes, (), {"_before": F.sum("_size").over(_earlier_runs(()))}
    )
    return carried.select(
        *df.columns, (position + F.coalesce(F.col("_before"), F.lit(0))).alias(name)
    )
