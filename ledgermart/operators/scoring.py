"""Batch scoring: features of one or many snapshots through a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stores import within

DECISION_THRESHOLD = 0.5


def shaped_predictions(
    scored: DataFrame, probability: str, version: Column, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Prediction-store rows: keys, version, probability, decision and time of scoring."""
    p = F.col(probability)
    return scored.select(
        "Customer_ID",
        "feature_snapshot_date",
        F.date_format("feature_snapshot_date", "yyyy-MM-dd").alias("snapshot_date"),
        version.alias("model_version"),
        p.alias("model_prediction_proba"),
        F.when(p >= threshold, 1).otherwise(0).alias("model_prediction_binary"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("prediction_timestamp"),
    )


def load_model(path: str, required: Sequence[str] = ("probability",)) -> PipelineModel:
    """A saved pipeline model; it must end in a classifier that gives probabilities."""
    model = PipelineModel.load(path)
    last = model.stages[-1]
    missing = [c for c in required if not last.hasParam(f"{c}Col")]
    if missing:
        raise ValueError(f"model at {path} does not produce {missing}")
    return model


def score(features: DataFrame, model: PipelineModel, version: str) -> DataFrame:
    """Scores of every feature row."""
    scored = model.transform(features).withColumn(
        "_default", vector_to_array(F.col("probability"))[1]
    )
    return shaped_predictions(scored, "_default", F.lit(version))


def score_window(
    features: DataFrame, model: PipelineModel, version: str, start: str, end: str
) -> DataFrame:
    """Scores of all snapshots from ``start`` to ``end`` in one job."""
    return score(within(features, start, end, "feature_snapshot_date"), model, version)
