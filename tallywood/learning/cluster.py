"""K-means clustering, cluster quality and anomalies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallywood.functions import squared_distance
from tallywood.learning import lines
from tallywood.learning.features import category_stages
from tallywood.learning.sweep import ROWS_AT_ONCE
from tallywood.operators.ranking import at_least_nth_largest
from tallywood.plans import shipped

# Iteration settings, numbers of clusters tried, and the number of
# clusters and the rank of the threshold used to find anomalies.
ITERATIONS = {"maxIter": 40, "tol": 1.0e-5}
K_RAW = range(20, 101, 20)
K_SCALED = range(60, 271, 30)
K_ANOMALIES = 180
ANOMALY_RANK = 100

CLUSTER = "cluster"


def feature_stages(
    numeric: Sequence[str], categorical: Sequence[str] = (), scaled: bool = False
) -> tuple[list, str]:
    """Stages from columns to a feature vector, and the vector's name."""
    stages: list = []
    inputs = list(numeric)
    if categorical:
        encoding, vectors = category_stages(categorical, invalid="keep")
        stages += encoding
        inputs += vectors
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    if not scaled:
        return stages, "features"
    stages.append(
        StandardScaler(inputCol="features", outputCol="scaled", withStd=True, withMean=False)
    )
    return stages, "scaled"


def prepare(df: DataFrame, stages: Sequence, rows: DataFrame | None = None) -> DataFrame:
    """Rows with their feature vector; fitted once for all numbers of clusters.

    ``rows`` are the rows to prepare, if they are not those the stages are fitted on.
    """
    return Pipeline(stages=list(stages)).fit(df).transform(df if rows is None else rows)


def counted_rows(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """Different rows of the columns with their ``number``, in the order in which lines are laid out.

    Several sweeps over one table prepare these rows in place of its own; the second result is the place of
    the column that runs along the lines.
    """
    shipped(df.sparkSession)
    rows, along = lines.together(df, categorical, numeric)
    return rows.withColumnRenamed("n", "number"), along


def fit_kmeans(
    prepared: DataFrame, features: str, k: int = 2, seed: int = 1, **params
) -> KMeansModel:
    return KMeans(featuresCol=features, predictionCol=CLUSTER, k=k, seed=seed, **params).fit(
        prepared
    )


def fit_pipeline(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    k: int,
    seed: int = 1,
    **params,
) -> tuple[PipelineModel, str]:
    """Encode, scale and cluster; the model and the name of its feature vector."""
    stages, features = feature_stages(numeric, categorical, scaled=True)
    kmeans = KMeans(featuresCol=features, predictionCol=CLUSTER, k=k, seed=seed, **params)
    return Pipeline(stages=[*stages, kmeans]).fit(df), features


def vector_lines(
    prepared: DataFrame, features: str, keep: Sequence[str] = (), along: int | None = None, number: str | None = None
) -> lines.Lines | None:
    """The vectors' values laid out as lines; none if there are no rows."""
    first = prepared.select(vector_to_array(features).alias("v")).head()
    if first is None:
        return None
    names = [f"_x{i}" for i in range(len(first["v"]))]
    # Exploded, so that the vector is made once a row and not once a value.
    more = [*keep, *([] if number is None else [number])]
    once = prepared.select(*more, F.explode(F.array(vector_to_array(features))).alias("_v"))
    values = [F.col("_v")[i].alias(n) for i, n in enumerate(names)]
    return lines.lines(once.select(*more, *values), names, keep, along, number)


def cost_sweep(
    prepared: DataFrame, features: str, ks: Sequence[int], seed: int = 1,
    maxIter: int = 20, tol: float = 1e-4, along: int | None = None, number: str | None = None,
) -> list[tuple[int, float]]:
    """Training cost per number of clusters, all fitted in the same scans.

    ``number`` and ``along`` tell of rows that ``counted_rows`` has counted.
    """
    held = vector_lines(prepared, features, (), along, number)
    if held is None:
        return []
    fitted = lines.fit_all(held, ks, maxIter, tol, seed)
    found = {r["k"]: r["cost"] for r in lines.costs(held, fitted).collect()}
    return [(k, found[k]) for k in ks]


def entropy_sweep(
    prepared: DataFrame, features: str, label: str, ks: Sequence[int], seed: int = 1,
    maxIter: int = 20, tol: float = 1e-4,
) -> DataFrame:
    """Size-weighted label entropy of the clusters, per number of clusters, fitted in the same scans."""
    held = vector_lines(prepared, features)
    if held is None:
        return prepared.sparkSession.createDataFrame([], "k int, entropy double")
    fitted = lines.fit_all(held, ks, maxIter, tol, seed)
    counts = lines.label_counts(vector_lines(prepared, features, [label], held.along), fitted, label)
    n = F.col("count").cast("double")
    sizes = counts.groupBy("k", CLUSTER).agg(F.sum(n).alias("size"), F.sum(n * F.log(n)).alias("inner"))
    spread = F.sum(F.col("size") * F.log("size") - F.col("inner")) / F.sum("size")
    return sizes.groupBy("k").agg(F.greatest(spread, F.lit(0.0)).alias("entropy"))


def label_counts(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, k: int,
    seed: int = 1, maxIter: int = 20, tol: float = 1e-4,
) -> DataFrame:
    """Rows (cluster, label, count) of the clusters of encoded and scaled columns."""
    stages, vector = feature_stages(numeric, categorical, scaled=True)
    prepared = prepare(df, stages)
    held = vector_lines(prepared, vector)
    if held is None:
        return df.select(F.lit(0).alias(CLUSTER), label, F.lit(0).cast("bigint").alias("count"))
    fitted = lines.fit_all(held, [k], maxIter, tol, seed)
    return lines.label_counts(vector_lines(prepared, vector, [label], held.along), fitted, label).drop("k")


def anomalies(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], k: int,
    rank: int = ANOMALY_RANK, seed: int = 1, maxIter: int = 20, tol: float = 1e-4,
) -> DataFrame:
    """Rows farthest from their cluster's center, with their squared ``distance`` to it.

    Encoded and scaled columns are clustered; one scan measures the rows.
    """
    stages, vector = feature_stages(numeric, categorical, scaled=True)
    prepared = prepare(df, stages)
    held = vector_lines(prepared, vector)
    if held is None:
        return df.withColumn("distance", F.lit(0.0))
    centers = lines.fit_all(held, [k], maxIter, tol, seed)[k].centers
    rows = prepared.select(*df.columns, vector_to_array(vector).alias("_point"))
    return farthest(_measured(rows, centers, df.schema), rank=rank)


def _measured(rows: DataFrame, centers: np.ndarray, schema: StructType) -> DataFrame:
    """Rows with the squared distance of ``_point``, their last column, to the nearest center."""
    width = centers.shape[1]
    lengths = (centers**2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.columns[-1].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            apart = np.zeros(len(points))
            for at in range(0, len(points), ROWS_AT_ONCE):
                some = points[at : at + ROWS_AT_ONCE]
                near = (lengths - 2 * some @ centers.T).argmin(axis=1)
                apart[at : at + ROWS_AT_ONCE] = ((some - centers[near]) ** 2).sum(axis=1)
            names = [*batch.schema.names[:-1], "distance"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(apart)], names)

    return rows.mapInArrow(run, StructType([*schema.fields, StructField("distance", DoubleType())]))


def center_table(model: KMeansModel, df: DataFrame) -> DataFrame:
    """Cluster centers, one row per cluster."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, f"{CLUSTER} int, center array<double>")


def group_centers(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, added up per task before the shuffle."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return df.groupBy(group).agg(vector_to_array(mean).alias("center"))


def distance_to_center(
    df: DataFrame, group: str, vector: str, centers: DataFrame, name: str = "distance"
) -> DataFrame:
    """Squared distance of every row to the center of its group."""
    joined = df.join(centers, group)
    measured = joined.withColumn(name, squared_distance(F.col(vector), F.col("center")))
    return measured.drop("center")


def farthest(df: DataFrame, distance: str = "distance", rank: int = ANOMALY_RANK) -> DataFrame:
    """Rows at least as far out as the ``rank``-th farthest, ties included."""
    return at_least_nth_largest(df, distance, rank)


def kmeans_anomalies(
    df: DataFrame, model: PipelineModel, features: str, rank: int = ANOMALY_RANK
) -> DataFrame:
    """Original columns of the rows farthest from their cluster's center."""
    clustered = model.transform(df).withColumn("_point", vector_to_array(features))
    centers = center_table(model.stages[-1], df)
    # One row per cluster of the model: its size does not depend on the data.
    measured = clustered.join(F.broadcast(centers), CLUSTER).withColumn(
        "distance", squared_distance(F.col("_point"), F.col("center"))
    )
    return farthest(measured.select(*df.columns, "distance"), rank=rank)
