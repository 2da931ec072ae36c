"""Feature preparation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    HashingTF,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.plans import find_heavy, number_rows
from tallywood.plans.skew import mark_heavy

# Fixed names of the claims data: the categorical prefix, the columns that are
# not features, and the columns with too many categories.
CATEGORY_PREFIX = "cat"
NOT_FEATURES = ("id", "label")
TOO_MANY_CATEGORIES = ("cat109", "cat110", "cat112", "cat113", "cat116")


def claim_features(columns: Sequence[str], index_prefix: str = "coded_") -> list[str]:
    """Feature columns of the claims data by the naming rule; categoricals prefixed."""
    kept = [c for c in columns if c not in NOT_FEATURES and c not in TOO_MANY_CATEGORIES]
    return [index_prefix + c if c.startswith(CATEGORY_PREFIX) else c for c in kept]


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def frequency_index(
    df: DataFrame, column: str, name: str, fit_on: DataFrame | None = None, keep: bool = False
) -> DataFrame:
    """Index values from 0 by falling frequency, equal counts by value.

    Works for any number of distinct values: they are counted, sorted and
    numbered across the cluster and joined back. ``fit_on`` may be a union of
    the tables that share the index. A null or unknown value has a null index, or with
    ``keep`` the one after the last.
    """
    counts = (fit_on if fit_on is not None else df).where(F.col(column).isNotNull())
    counts = counts.groupBy(column).agg(F.count(F.lit(1)).alias("_count"))
    numbered = number_rows(counts, [F.desc("_count"), column], "_place")
    index = numbered.select(column, F.col("_place").cast("double").alias(name))
    joined = df.join(index, column, "left").select(*df.columns, name)
    if not keep:
        return joined
    return joined.withColumn(name, F.coalesce(name, F.lit(float(index.count()))))


def index_categories(
    df: DataFrame, names: dict[str, str], fit_on: DataFrame | None = None
) -> DataFrame:
    """Add the frequency index of each column of ``{column: name}``.

    Every column is indexed on its own non-null values, whatever the others hold.
    """
    for column, name in names.items():
        df = frequency_index(df, column, name, fit_on, keep=True)
    return df


def category_stages(
    columns: Sequence[str], one_hot: bool = True, invalid: str = "error"
) -> tuple[list, list[str]]:
    """Indexer (and one-hot) stages for categorical columns, and their outputs."""
    indexed = [f"{c}_indexed" for c in columns]
    stages = [
        StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid=invalid)
    ]
    if not one_hot:
        return stages, indexed
    vectors = [f"{c}_vec" for c in columns]
    stages.append(OneHotEncoder(inputCols=indexed, outputCols=vectors))
    return stages, vectors


def one_hot(df: DataFrame, index: str, name: str, drop_last: bool = True) -> DataFrame:
    """0/1 columns ``<name>_0`` ... of an index column, as many as it has values."""
    encoder = OneHotEncoder(inputCols=[index], outputCols=["_vec"], dropLast=drop_last)
    fitted = encoder.fit(df)
    encoded = fitted.transform(df)
    flags = vector_to_array("_vec")
    width = fitted.categorySizes[0] - (1 if drop_last else 0)
    return encoded.select(
        *df.columns, *[F.get(flags, F.lit(i)).alias(f"{name}_{i}") for i in range(width)]
    )


def scale(df: DataFrame, features: str, name: str = "scaled") -> DataFrame:
    """Vectors divided by the standard deviation of each dimension."""
    scaler = StandardScaler(inputCol=features, outputCol=name, withStd=True, withMean=False)
    return scaler.fit(df).transform(df)


def index_vector(df: DataFrame, features: str, name: str, max_categories: int = 40) -> DataFrame:
    """Dimensions with few distinct values become category indexes."""
    indexer = VectorIndexer(inputCol=features, outputCol=name, maxCategories=max_categories)
    return indexer.fit(df).transform(df)


def tokenize(df: DataFrame, text: str, name: str = "words") -> DataFrame:
    """Lower-cased words cut at each white-space character."""
    return Tokenizer(inputCol=text, outputCol=name).transform(df)


def hash_terms(df: DataFrame, words: str, name: str, size: int) -> DataFrame:
    return HashingTF(inputCol=words, outputCol=name, numFeatures=size).transform(df)


def term_hash(term: Column) -> Column:
    """The first 32 bits of a term's MD5 as a number: the same in any engine."""
    return F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint")


def hashed_counts(df: DataFrame, key: str, words: str, sizes: Sequence[int]) -> DataFrame:
    """Rows (key, size, place, n): how many of a key's words hash to a place below ``size``.

    Words are hashed once, to their remainder by the least common multiple of the sizes, and
    only these numbers are shuffled, by key. In long form, so a text may have any number of
    words and ``sizes`` any height. Null and empty lists of words give no rows.
    """
    if not sizes or min(sizes) < 1:
        raise ValueError("sizes are 1 or more")
    base = math.lcm(*sizes)
    kind = "int" if base < 1 << 31 else "bigint"

    def place(term: Column) -> Column:
        return (term_hash(term) % base if kind == "int" else term_hash(term)).cast(kind)

    def counted(rows: DataFrame) -> DataFrame:
        places = F.array(
            *[F.struct(F.lit(s).alias("size"), (F.col("_hash") % s).cast("bigint").alias("place")) for s in sizes]
        )
        each = rows.select(key, F.explode("_hashes").alias("_hash")).select(key, F.inline(places))
        return each.groupBy(key, "size", "place").agg(F.count(F.lit(1)).alias("n"))

    hashed = df.select(key, F.transform(words, place).alias("_hashes"))
    # A key's rows meet before its words are spread out, but for keys of very many rows.
    heavy = find_heavy(df, [key])
    marked = hashed.withColumn("_n", F.lit(None).cast("bigint")) if heavy is None else mark_heavy(hashed, heavy)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = counted(marked.where("_n IS NULL").drop("_n").repartition(parts, key))
    return found if heavy is None else found.unionAll(counted(marked.where("_n IS NOT NULL")))


def feature_names(df: DataFrame, features: str) -> list[str]:
    """Names of the dimensions of an assembled vector, from its metadata."""
    attrs = df.schema[features].metadata["ml_attr"]["attrs"]
    named = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    return [name for _, name in sorted(named)]


def importance_table(model: PipelineModel, names: Sequence[str], df: DataFrame) -> DataFrame:
    """Importance of every feature of a tree model, highest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")
