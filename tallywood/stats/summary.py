"""Summaries of vectors and classes."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.operators.groups import class_shares


def vector_summary(df: DataFrame, features: str, weight: str | None = None) -> DataFrame:
    """Mean and unbiased variance per dimension, weighted if asked, in one pass."""
    metrics = Summarizer.metrics("mean", "variance")
    found = metrics.summary(F.col(features), F.col(weight) if weight else F.lit(1.0))
    one = df.select(found.alias("s")).select(
        F.arrays_zip(
            vector_to_array("s.mean").alias("mean"),
            vector_to_array("s.variance").alias("variance"),
        ).alias("both")
    )
    return one.select(F.posexplode("both").alias("dim", "value")).select(
        "dim", "value.mean", "value.variance"
    )


def baseline_accuracy(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Accuracy of guessing at random by the train shares of the classes."""
    a = class_shares(train, label, "_train").select(label, "_train")
    b = class_shares(test, label, "_test").select(label, "_test")
    both = a.join(b, label)
    return both.agg(F.sum(F.col("_train") * F.col("_test")).alias("accuracy"))
