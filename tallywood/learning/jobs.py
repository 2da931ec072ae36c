"""Whole jobs from typed records to a tuned model, its reports and its output.

Each takes frames as the ``sources.layouts`` readers give them, and a grid; the
presets in ``models.GRIDS`` are the full ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import (
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.functions import one_hot_index
from tallywood.learning import cluster, evaluate, features, models, recommend, tuning
from tallywood.operators import groups, rows
from tallywood.plans import find_heavy, materialized
from tallywood.sources import layouts
from tallywood.stats import baseline_accuracy

# Shares and seeds of the splits, the share kept of each churn class,
# the columns that churn models leave out, and the columns they use.
CLAIM_SPLIT = (0.75, 0.25)
CLAIM_SEED = 12345
CHURN_FRACTIONS = {"False": 0.1675, "True": 1.0}
CHURN_SEED = 123456
CHURN_DROPPED = (
    "state_code", "area_code", "voice_mail_plan", "total_day_charge", "total_evening_charge",
)
CHURN_FEATURES = [
    "account_length", "plan_code", "num_voice_mail", "total_day_mins", "total_day_calls",
    "total_evening_mins", "total_evening_calls", "total_night_mins", "total_night_calls",
    "total_international_mins", "total_international_calls", "total_international_num_calls",
]
COVER_CLASSES = range(1, 8)


@dataclass(frozen=True)
class Trained:
    """A tuned model, its reports by name, and its predictions."""

    model: Model
    reports: Mapping[str, DataFrame]
    predictions: DataFrame


def encode_claims(
    frames: Sequence[DataFrame], every_row: DataFrame, columns: Sequence[str], one_hot: bool
) -> list[DataFrame]:
    """Frames with the vector ``features``; categories are indexed on ``every_row``.

    The encoding is worked out once, so a search that follows only fits its model.
    """
    names = features.claim_features(columns)
    coded = {c: f"coded_{c}" for c in columns if f"coded_{c}" in names}
    indexed = [
        materialized(features.index_categories(f, coded, every_row), "indexed") for f in frames
    ]
    inputs = list(names)
    stages: list = []
    if one_hot and coded:
        flags = [f"flags_{c}" for c in coded]
        encoder = OneHotEncoder(
            inputCols=list(coded.values()), outputCols=flags, handleInvalid="keep"
        )
        stages.append(encoder)
        inputs = [n if n not in coded.values() else f"flags_{n.removeprefix('coded_')}" for n in names]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    fitted = Pipeline(stages=stages).fit(indexed[0])
    return [fitted.transform(f) for f in indexed]


def claims_severity(
    train: DataFrame,
    test: DataFrame,
    kind: str,
    grid: Mapping[str, Sequence],
    folds: int = models.DEFAULT_FOLDS,
) -> Trained:
    """Predict the loss of claims; the output has columns ``id`` and ``loss``.

    ``kind`` is ``linear_regression``, ``gbt_regression`` or
    ``forest_regression``. Reports: ``train``, ``validation``, ``grid``.
    """
    every_row = rows.union_rows(train, test, ["loss"])
    labelled = train.withColumnRenamed("loss", "label").dropna(subset=["label"])
    numbers = [c for c in labelled.columns if not c.startswith(features.CATEGORY_PREFIX)]
    labelled, unlabelled = encode_claims(
        [labelled.dropna(subset=numbers), test.fillna(0.0)], every_row, labelled.columns,
        one_hot=kind == "linear_regression",
    )
    fitting, validation = rows.key_split(labelled, ["id"], CLAIM_SPLIT, CLAIM_SEED)
    model = models.estimator(kind)
    best = tuning.cross_validate_counted(
        fitting, ["id"], model, tuning.param_grid(grid, model), folds, models.SEED,
        draws=kind == "forest_regression",
    )
    scored = best.transform(unlabelled)
    return Trained(
        best,
        {
            "train": evaluate.regression_report(best.transform(fitting)),
            "validation": evaluate.regression_report(best.transform(validation)),
            "grid": tuning.leaderboard(best, tuning.CountedError(), train),
        },
        scored.select(F.col("id").cast("bigint").alias("id"), F.col("prediction").alias("loss")),
    )


def churn_classification(
    train: DataFrame,
    test: DataFrame,
    kind: str,
    grid: Mapping[str, Sequence],
    folds: int = models.DEFAULT_FOLDS,
    fractions: Mapping[str, float] = CHURN_FRACTIONS,
) -> Trained:
    """Predict which accounts churn, from a class-balanced sample.

    ``kind`` is ``logistic``, ``svm``, ``tree`` or ``forest``. Reports:
    ``outcomes`` and ``areas`` of the test accounts, ``grid``.
    """
    balanced = rows.stratified_sample(train, "churn", fractions, CHURN_SEED)
    model = models.estimator(kind)
    stages = [
        StringIndexer(inputCol="international_plan", outputCol="plan_code"),
        StringIndexer(
            inputCol="churn", outputCol="label", stringOrderType="alphabetAsc"
        ),
        VectorAssembler(inputCols=CHURN_FEATURES, outputCol="features"),
        model,
    ]
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="prediction")
    best = tuning.cross_validate(
        balanced.drop(*CHURN_DROPPED),
        Pipeline(stages=stages),
        tuning.param_grid(grid, model),
        evaluator,
        folds,
        models.SEED,
    )
    scored = best.transform(test)
    return Trained(
        best,
        {
            "outcomes": evaluate.outcome_report(scored),
            "areas": evaluate.curve_areas(scored, "prediction"),
            "grid": tuning.leaderboard(best, evaluator, train),
        },
        scored.select("label", "prediction"),
    )


def churn_totals(accounts: DataFrame) -> DataFrame:
    """Charges per churn class and in total, largest total first."""
    # The names of the columns of the result.
    measures = {
        "TDC": "total_day_charge",
        "TEC": "total_evening_charge",
        "TNC": "total_night_charge",
        "TIC": "total_international_charge",
    }
    return groups.class_totals(accounts, "churn", measures, "Total_charge")


def decode_cover(cover: DataFrame) -> DataFrame:
    """The two groups of 0/1 columns as one category column each."""
    return cover.select(
        *layouts.COVER_NUMBERS,
        layouts.COVER_LABEL,
        one_hot_index(layouts.COVER_WILDERNESS).alias("wilderness"),
        one_hot_index(layouts.COVER_SOIL).alias("soil"),
    )


def cover_classification(
    train: DataFrame,
    test: DataFrame,
    kind: str,
    grid: Mapping[str, Sequence],
    decoded: bool = True,
    **params,
) -> Trained:
    """Predict the land cover class by a ``tree`` or ``forest``.

    With ``decoded`` the 0/1 columns become categories first. Reports of the
    test rows: ``accuracy``, ``confusion``, ``baseline``, ``importances``;
    and ``grid``.
    """
    label = layouts.COVER_LABEL
    known, held_out = (decode_cover(train), decode_cover(test)) if decoded else (train, test)
    inputs = [c for c in known.columns if c != label]
    model = models.estimator(kind, "indexed", label, **params)
    stages = [
        VectorAssembler(inputCols=inputs, outputCol="features"),
        VectorIndexer(
            inputCol="features", outputCol="indexed", maxCategories=40, handleInvalid="keep"
        ),
        model,
    ]
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    best = tuning.validate_once(
        known,
        Pipeline(stages=stages),
        tuning.param_grid(grid, model),
        evaluator,
        models.TRAIN_RATIO,
        models.SEED,
    )
    scored = best.transform(held_out)
    return Trained(
        best,
        {
            "accuracy": evaluate.accuracy_f1(scored, label),
            "confusion": evaluate.confusion_matrix(
                scored, [float(c) for c in COVER_CLASSES], label
            ),
            "baseline": baseline_accuracy(train, test, label),
            "importances": features.importance_table(best.bestModel, inputs, known),
            "grid": tuning.leaderboard(best, evaluator, known),
        },
        scored.select(label, "prediction"),
    )


def network_anomalies(
    records: DataFrame, k: int = cluster.K_ANOMALIES, rank: int = cluster.ANOMALY_RANK
) -> DataFrame:
    """Records farthest from their cluster's center, original columns only."""
    text = {*layouts.NETWORK_CATEGORIES, layouts.NETWORK_LABEL}
    numbers = [c for c in records.columns if c not in text]
    found = cluster.anomalies(
        records, numbers, layouts.NETWORK_CATEGORIES, k, rank, **cluster.ITERATIONS
    )
    return found.drop("distance")


def recommender_auc(
    plays: DataFrame, aliases: DataFrame, seed: int = 0, **als_params
) -> DataFrame:
    """Mean per-user AUC of popularity and of factorisation, on a held-out tenth."""
    counts = materialized(
        recommend.interaction_counts(plays, "user", "item", "plays", aliases), "interactions"
    )
    train, held_out = rows.key_split(counts, ["user", "item"], [0.9, 0.1], seed)
    negatives = materialized(
        recommend.sample_negatives(held_out, counts, "user", "item", seed), "negatives"
    )
    heavy_users = find_heavy(held_out, ["user"])
    scores = recommend.popularity(train, "item", "plays")
    model = recommend.fit_als(train, "user", "item", "plays", seed, **als_params)

    def by_popularity(pairs: DataFrame) -> DataFrame:
        return recommend.predict_popularity(pairs, scores, "item")

    out = None
    for name, predict in (("popularity", by_popularity), ("factors", model.transform)):
        found = recommend.mean_user_auc(
            held_out, negatives, predict, "user", "item", heavy_users
        ).select(F.lit(name).alias("scores"), "auc", "n_users")
        out = found if out is None else out.unionAll(found)
    return out
