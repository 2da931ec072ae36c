"""Chi-square tests of independence between categories and a label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.functions.special import chi_square_tail
from tallywood.plans import materialized


def chi_square(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Statistic and degrees of freedom per feature.

    With observed counts O and expected ones E = R C / N from the row and column
    totals, the statistic is the sum of (O - E)^2 / E. An empty cell adds its E, and
    all E add up to N, so the empty cells together add N less the E of the filled
    ones, and the full table of rows and columns is never laid out. The counts are
    written out, since every total is made from them and not from the rows.
    Pairs with a null are left out.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
            for f in features
        ]
    )
    long = df.select(F.col(label).cast("string").alias("label"), F.inline(pairs)).dropna()
    counts = long.groupBy("feature", "value", "label").agg(F.count(F.lit(1)).alias("o"))
    cells = materialized(counts, "contingency")
    rows = cells.groupBy("feature", "value").agg(F.sum("o").alias("r"))
    columns = cells.groupBy("feature", "label").agg(F.sum("o").alias("c"))
    shape = rows.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("r").alias("n")
    )
    widths = columns.groupBy("feature").agg(F.count(F.lit(1)).alias("n_columns"))
    spread = (
        cells.join(rows, ["feature", "value"])
        .join(columns, ["feature", "label"])
        .join(shape, "feature")
        .withColumn("e", F.col("r") / F.col("n") * F.col("c"))
        .groupBy("feature", "n_rows", "n")
        .agg(
            F.sum((F.col("o") - F.col("e")) * (F.col("o") - F.col("e")) / F.col("e")).alias("s"),
            F.sum("e").alias("filled"),
        )
    )
    return (
        spread.join(widths, "feature")
        .select(
            "feature",
            (F.col("s") + (F.col("n") - F.col("filled"))).alias("statistic"),
            ((F.col("n_rows") - 1) * (F.col("n_columns") - 1)).alias("dof"),
        )
    )


def chi_square_p_values(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``chi_square`` with the chance of a statistic as large if label and feature are apart.

    A column expression over the statistic: any values, any number of them.
    """
    return chi_square(df, features, label).withColumn(
        "p_value", chi_square_tail(F.col("statistic"), F.col("dof"))
    )
