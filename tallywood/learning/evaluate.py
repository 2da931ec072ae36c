"""Evaluation reports, each one aggregate over the predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.operators.groups import count_by, pivot_counts
from tallywood.plans import running_sums


def outcome_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1.0
) -> DataFrame:
    """Counts and ratios of right and wrong binary predictions, in one pass."""
    right = F.col(label) == F.col(prediction)
    said_yes = F.col(prediction) == positive
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(right).alias("correct"),
        F.count_if(~right).alias("wrong"),
        F.count_if(right & said_yes).alias("tp"),
        F.count_if(right & ~said_yes).alias("tn"),
        F.count_if(~right & said_yes).alias("fp"),
        F.count_if(~right & ~said_yes).alias("fn"),
    )

    def ratio(name: str):
        return F.col(name) / F.col("total")

    return counted.select(
        "total",
        "correct",
        "wrong",
        ratio("wrong").alias("ratio_wrong"),
        ratio("correct").alias("ratio_correct"),
        ratio("tp").alias("ratio_tp"),
        ratio("fp").alias("ratio_fp"),
        ratio("tn").alias("ratio_tn"),
        ratio("fn").alias("ratio_fn"),
    )


def _score_curve(df: DataFrame, score: str, label: str, positive: float) -> DataFrame:
    """Positives and negatives per distinct score, and from the top down to it."""
    is_positive = F.when(F.col(label) == positive, 1).otherwise(0).cast("long")
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(is_positive).alias("pos"), F.sum(1 - is_positive).alias("neg")
    )
    return running_sums(per_score, [F.desc("threshold")], {"tp": "pos", "fp": "neg"})


def threshold_curve(
    df: DataFrame, score: str, label: str = "label", positive: float = 1.0
) -> DataFrame:
    """Precision, recall and F1 when everything at or above a score is positive."""
    curve = _score_curve(df, score, label, positive)
    # The curve is read twice and ends at the totals.
    all_positive = curve.agg(F.max("tp")).scalar()
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.try_divide("tp", all_positive)
    both = F.col("precision") + F.col("recall")
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), both)
    return (
        curve.select("threshold", precision.alias("precision"), recall.alias("recall"))
        .withColumn("f1", F.coalesce(f1, F.lit(0.0)))
    )


def curve_areas(
    df: DataFrame, score: str, label: str = "label", positive: float = 1.0
) -> DataFrame:
    """Areas under the ROC and the precision-recall curve, by trapezoids.

    Each point of the curve knows the point before it (its running counts less
    its own), so every trapezoid is made from one row. The precision-recall
    curve starts at recall 0 with the precision of its first point.
    """
    curve = _score_curve(df, score, label, positive)
    tp, fp = F.col("tp"), F.col("fp")
    tp_before, fp_before = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / (tp + fp)
    precision_before = F.coalesce(F.try_divide(tp_before, tp_before + fp_before), precision)
    sums = curve.agg(
        F.sum(F.col("neg") * (tp + tp_before) / 2.0).alias("roc"),
        F.sum(F.col("pos") * (precision + precision_before) / 2.0).alias("pr"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    return sums.select(
        F.try_divide(F.col("roc"), F.col("p") * F.col("n").cast("double")).alias("area_under_roc"),
        F.try_divide("pr", "p").alias("area_under_pr"),
    )


def accuracy_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and F1 weighted by class size.

    Computed from the counts per (label, prediction); a class that is only
    ever predicted has no weight.
    """
    cells = count_by(df.select(F.col(label).alias("l"), F.col(prediction).alias("p")), "l", "p")
    both = F.array(
        F.struct(F.col("l").cast("double").alias("c"), F.col("n").alias("actual"),
                 F.lit(0).cast("long").alias("said"),
                 F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").cast("double").alias("c"), F.lit(0).cast("long").alias("actual"),
                 F.col("n").alias("said"), F.lit(0).cast("long").alias("hit")),
    )
    classes = cells.select(F.inline(both)).groupBy("c").agg(
        F.sum("actual").alias("actual"), F.sum("said").alias("said"), F.sum("hit").alias("hit")
    )
    f1 = 2.0 * F.col("hit") / (F.col("actual") + F.col("said"))
    return classes.agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"),
        (F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("f1"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return count_by(df, label, prediction)


def confusion_matrix(
    df: DataFrame, values: Sequence, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Labels down, the named predictions across."""
    return pivot_counts(df, label, prediction, values)


def regression_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """MSE, RMSE, R squared, MAE and explained variance, in one pass.

    Explained variance is the mean squared distance of the predictions from
    the mean label.
    """
    error = F.col(label) - F.col(prediction)
    sums = df.agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("label_variance"),
        F.var_pop(prediction).alias("prediction_variance"),
        (F.avg(prediction) - F.avg(label)).alias("offset"),
    )
    return sums.select(
        "mse",
        F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide("mse", "label_variance")).alias("r2"),
        "mae",
        (F.col("prediction_variance") + F.col("offset") * F.col("offset")).alias(
            "explained_variance"
        ),
    )
