"""Correlation matrices as long tables ``(i, j, corr)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.plans import materialized, running_sums


# Most distinct values of a column whose ranks are looked up in each row, without a join.
FEW_VALUES = 256


def pearson_vectors(df: DataFrame, features: str, names: Sequence[str]) -> DataFrame:
    """Pearson correlation of the dimensions of a vector column.

    One distributed pass; the result has one row per pair of dimensions. A
    constant dimension correlates as NaN with every other.
    """
    matrix = Correlation.corr(df, features).head()[0].toArray()
    rows = [
        (a, b, float(matrix[i][j])) for i, a in enumerate(names) for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(rows, "i string, j string, corr double")


def pearson(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Pearson correlation of numeric columns; rows with a null are left out.

    Two aggregates in one row each: the weighted means, then the sums of products
    around them. A constant column correlates as NaN with every other; without rows
    every cell is NaN but those of a column with itself.
    """
    values = [F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)]
    size = range(len(columns))
    times = (F.col(weight) if weight else F.lit(1)).cast("double").alias("_w")
    rows = df.select(*values, times).dropna()
    means = rows.agg(
        *[(F.sum(F.col(f"_v{i}") * F.col("_w")) / F.sum("_w")).alias(f"_m{i}") for i in size]
    ).head()
    return _around([F.col(f"_v{i}") - F.lit(means[i]) for i in size], rows, columns)


def _around(centred: Sequence[Column], rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The matrix from ``rows`` with weights ``_w``, by values less their means."""
    size = range(len(columns))
    sums = rows.agg(
        *[
            F.sum(centred[i] * centred[j] * F.col("_w")).alias(f"_c{i}_{j}")
            for i, j in combinations_with_replacement(size, 2)
        ]
    )

    def cell(i: int, j: int) -> Column:
        both = F.sqrt(F.col(f"_c{i}_{i}")) * F.sqrt(F.col(f"_c{j}_{j}"))
        covariance = F.col(f"_c{min(i, j)}_{max(i, j)}")
        value = F.lit(1.0) if i == j else F.coalesce(
            F.when(both == 0, F.lit(float("nan"))).otherwise(F.try_divide(covariance, both)),
            F.lit(float("nan")),
        )
        return F.struct(
            F.lit(columns[i]).alias("i"), F.lit(columns[j]).alias("j"), value.alias("corr")
        )

    return sums.select(F.inline(F.array(*[cell(i, j) for i in size for j in size])))


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows with their count ``n`` and each column replaced by its rank.

    Ties share their mean rank. Equal rows are counted before anything else, and ranks
    come from counts of the distinct values, so neither a row nor a value that a large
    share of the rows has in common is gathered anywhere. All columns are ranked by one
    range shuffle of (column, value). Ranks of columns with few values, where a value has
    many rows, are looked up; all others come back by one join, however many there are.
    """
    return _ranked(df, columns)[0]


def _ranked(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, int]:
    """``average_ranks`` and the number of rows ranked."""
    counted = df.select(*columns).dropna().groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    base = materialized(counted.withColumn("_id", F.monotonically_increasing_id()), "counted-rows")
    # All columns in one: a value lies in the field of its own type, so that none is cast.
    kinds = dict(base.select(*columns).dtypes)
    fields = {kind: f"_v{i}" for i, kind in enumerate(sorted(set(kinds.values())))}
    def place(i: int, c: str) -> Column:
        own = [(F.col(c) if kinds[c] == k else F.lit(None).cast(k)).alias(f) for k, f in fields.items()]
        return F.struct(F.lit(i).alias("_c"), *own)

    value = ["_c", *fields.values()]
    stacked = base.select("n", F.inline(F.array(*[place(i, c) for i, c in enumerate(columns)])))
    counts = stacked.groupBy(*value).agg(F.sum("n").alias("_count"))
    # One running count through all columns; each column's begins after whole ones.
    rows = base.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head()["n"]
    through = F.col("_through") - F.col("_c") * F.lit(rows)
    ranks = running_sums(counts, value, {"_through": "_count"}).select(
        *value, (through - (F.col("_count") - 1) / 2.0).alias("_rank")
    )
    ranks = materialized(ranks, "ranks")
    sizes = {r["_c"]: r["count"] for r in ranks.groupBy("_c").count().collect()}
    few = [i for i in range(len(columns)) if sizes.get(i, 0) <= FEW_VALUES]
    many = [i for i in range(len(columns)) if i not in few]
    found = base.select("_id", "n", *columns, *[_looked_up(ranks, i, c, fields[kinds[c]]).alias(f"_rank{i}")
                                                for i, c in enumerate(columns) if i in few])
    if many:
        known = [f"_rank{i}" for i in few]
        open_ = F.inline(F.array(*[place(i, columns[i]) for i in many]))
        same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in value]
        joined = found.select("_id", "n", *known, open_).join(
            ranks.select(*[F.col(c).alias(f"_of{c}") for c in value], "_rank"), reduce(Column.__and__, same)
        )
        if len(many) == 1:  # a row is still one row
            found = joined.withColumnRenamed("_rank", f"_rank{many[0]}")
        else:
            own = [F.max(F.when(F.col("_c") == i, F.col("_rank"))).alias(f"_rank{i}") for i in many]
            found = joined.groupBy("_id").agg(*own, *[F.max(c).alias(c) for c in ("n", *known)])
    wide = found.select(*[F.col(f"_rank{i}").alias(c) for i, c in enumerate(columns)], "n")
    return wide, rows


def _looked_up(ranks: DataFrame, i: int, column: str, field: str) -> Column:
    """The rank of a value of the ``i``-th column, which has few of them."""
    entries = F.map_from_entries(F.collect_list(F.struct(field, "_rank")))
    return F.element_at(ranks.where(F.col("_c") == i).agg(entries.alias("m")).scalar(), F.col(column))


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spearman rank correlation: Pearson correlation of the ranks.

    The mean of all ranks is (rows + 1) / 2, so one aggregate over them is enough.
    """
    ranks, rows = _ranked(df, columns)
    weighted = ranks.withColumn("_w", F.col("n").cast("double"))
    return _around([F.col(c) - F.lit((rows + 1) / 2.0) for c in columns], weighted, columns)
