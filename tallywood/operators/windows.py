"""First, last and filled values along an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.plans import running_first_last
from tallywood.plans.skew import HEAVY_ROWS


def first_last_non_null(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    first: str = "first_val",
    last: str = "last_val",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """First and last non-null value of a column up to each row of its group."""
    return running_first_last(
        df, keys, order, {first: column}, {last: column}, min_rows=min_rows
    )


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    name: str | None = None,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Replace a null by the last value before it in its group."""
    filled = running_first_last(df, keys, order, last={"_filled": column}, min_rows=min_rows)
    if name is None:
        return filled.withColumn(column, F.col("_filled")).drop("_filled")
    return filled.withColumnRenamed("_filled", name)
