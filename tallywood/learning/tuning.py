"""Grid search by cross validation or a single split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Params
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.plans import checkpoint_root, materialized, persisted

# Rows that a task of a fit reads at least, where there are more than one such lot a core.
TASK_ROWS = 50_000


def param_grid(grid: Mapping[str, Sequence], *stages: Params) -> list:
    """All combinations of ``{parameter: values}``, for the stages that have them."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        owners = [s for s in stages if s.hasParam(name)]
        if len(owners) != 1:
            raise ValueError(f"{name} belongs to {len(owners)} of the given stages")
        builder.addGrid(owners[0].getParam(name), list(values))
    return builder.build()


def cross_validate(
    df: DataFrame,
    search: Estimator,
    grid: list,
    evaluator: Evaluator,
    folds: int,
    seed: int,
    parallelism: int = 4,
    n_rows: int | None = None,
) -> Model:
    """Best model by k-fold cross validation; the rows are cached meanwhile.

    ``n_rows``, where known, deals them to as many tasks as cores, or more for more than
    ``TASK_ROWS`` each: a fit of many passes over few rows waits for its tasks to start.
    """
    checkpoint_root(df.sparkSession)
    validator = CrossValidator(
        estimator=search,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    if n_rows is None:
        with persisted(df) as rows:
            return validator.fit(rows)
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // TASK_ROWS))
    held = df.repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return validator.fit(held)
    finally:
        held.unpersist()


class CountedError(Evaluator):
    """Root mean squared error of all rows that ``counted_rows`` put together."""

    def _evaluate(self, dataset: DataFrame) -> float:
        apart = F.col("prediction") - F.col("label")
        squares = F.col("weight") * apart * apart + F.col("within")
        return float(dataset.agg(F.sqrt(F.sum(squares) / F.sum("weight")).alias("e")).head()["e"] or 0.0)

    def isLargerBetter(self) -> bool:
        return False


def counted_rows(df: DataFrame, fold: Column, apart: bool, features: str = "features", label: str = "label") -> DataFrame:
    """One row (features, label, weight, within, fold) for all rows of equal features in a fold.

    Least squares know equal rows by their number, mean label and the squares around it
    (``within``), so nothing is lost: a split's gain is the same. With ``apart`` rows of
    different labels stay apart, for models that draw rows.
    """
    rows = df.select(vector_to_array(features).alias("_x"), F.col(label).cast("double").alias("_y"), fold.alias("fold"))
    keys = ["_x", "fold", *(["_y"] if apart else [])]
    size = F.count(F.lit(1)).cast("double")
    mean, within = (F.col("_y"), F.lit(0.0)) if apart else (F.avg("_y"), F.var_pop("_y") * size)
    sums = [size.alias("weight"), within.alias("within"), *([] if apart else [mean.alias("label")])]
    found = rows.groupBy(*keys).agg(*sums)
    if apart:
        found = found.withColumnRenamed("_y", "label")
    return found.select(array_to_vector("_x").alias("features"), "label", "weight", "within", "fold")


def cross_validate_counted(
    df: DataFrame,
    key: Sequence[str],
    search: Estimator,
    grid: list,
    folds: int,
    seed: int,
    draws: bool,
    parallelism: int = 4,
) -> Model:
    """Best least-squares model by k-fold cross validation over counted rows.

    Folds follow from the rows' ``key``. The fits read one row per different features and
    fold, however many rows share them. ``draws``: the model draws rows (a forest); labels
    then stay apart, and equal rows are drawn together, with their weight.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    fold = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(folds)).cast("int")
    known = df.dropna(subset=["label"])
    counted = materialized(counted_rows(known, fold, draws), "counted-rows")
    there = sorted(r["fold"] for r in counted.select("fold").distinct().collect())
    if len(there) < folds:  # few rows: the folds that have some, numbered from 0
        number = F.array_position(F.array(*[F.lit(f) for f in there]), F.col("fold")) - 1
        counted = counted.withColumn("fold", number.cast("int"))
    validator = CrossValidator(
        estimator=search.copy().setWeightCol("weight"),
        estimatorParamMaps=grid,
        evaluator=CountedError(),
        numFolds=max(len(there), 2),
        seed=seed,
        parallelism=parallelism,
        foldCol="fold" if len(there) > 1 else "",
    )
    # Few rows but many passes: dealt to all cores, not by size.
    held = counted.repartition(spark.sparkContext.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return validator.fit(held)
    finally:
        held.unpersist()


def validate_once(
    df: DataFrame,
    search: Estimator,
    grid: list,
    evaluator: Evaluator,
    train_ratio: float,
    seed: int,
    parallelism: int = 4,
) -> Model:
    """Best model by one train and validation split; the rows are cached meanwhile."""
    checkpoint_root(df.sparkSession)
    validator = TrainValidationSplit(
        estimator=search,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        trainRatio=train_ratio,
        seed=seed,
        parallelism=parallelism,
    )
    with persisted(df) as rows:
        return validator.fit(rows)


def leaderboard(model: Model, evaluator: Evaluator, df: DataFrame) -> DataFrame:
    """Parameter sets of a search with their metric, best first."""
    metrics = getattr(model, "avgMetrics", None) or model.validationMetrics
    rows = []
    for metric, params in zip(metrics, model.getEstimatorParamMaps(), strict=True):
        shown = ", ".join(sorted(f"{p.name}={v}" for p, v in params.items()))
        rows.append((shown, float(metric)))
    rows.sort(key=lambda r: (-r[1] if evaluator.isLargerBetter() else r[1], r[0]))
    ranked = [(place + 1, shown, metric) for place, (shown, metric) in enumerate(rows)]
    return df.sparkSession.createDataFrame(ranked, "place int, params string, metric double")
