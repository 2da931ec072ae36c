"""What a fitted model learned and how it was set up."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def last_stage(model):
    """The predictor of a fitted search or pipeline."""
    best = getattr(model, "bestModel", model)
    return best.stages[-1] if isinstance(best, PipelineModel) else best


def parameter_table(model, df: DataFrame) -> DataFrame:
    """Parameters of the predictor with their values and meaning."""
    stage = last_stage(model)
    rows = [
        (p.name, str(value), p.doc)
        for p, value in sorted(stage.extractParamMap().items(), key=lambda item: item[0].name)
    ]
    return df.sparkSession.createDataFrame(rows, "parameter string, value string, meaning string")
