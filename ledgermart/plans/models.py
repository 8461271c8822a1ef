"""Training, scoring and monitoring flows over the gold stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mlprep, monitoring, training
from ..operators.calendar import month_calendar, training_window
from ..operators.registry import latest_versions, version_name
from ..operators.scoring import load_model, score_window
from ..session import checkpointed
from ..sources import stores
from ..sources.schemas import LABEL_STORE_SCHEMA
from .lake import Lake

REGISTRY_KEY = "model_version string, training_date date, auc_oot double"


def training_data(spark: SparkSession, lake: Lake, training_date: str) -> DataFrame:
    """Split training rows of one training date, computed once."""
    window = training_window(spark, training_date)
    features, labels = stores.load_training_window(
        spark.read.parquet(lake.features),
        spark.read.parquet(lake.labels),
        window.train_test_start,
        window.oot_end,
    )
    joined = checkpointed(mlprep.training_rows(labels, features))
    return checkpointed(mlprep.with_splits(joined, window))


def run_training(
    spark: SparkSession,
    lake: Lake,
    training_date: str,
    model_types: Sequence[str] | None = None,
    draws: int = 10,
    folds: int = 3,
    seed: int = 88,
    parallelism: int = 2,
) -> DataFrame:
    """Train every model family for one date, save the models, and return their registry rows."""
    rows = training_data(spark, lake, training_date)
    train = rows.where("split = 'train'")
    entries = []
    for model_type in training.model_types(model_types):
        model = training.train_model(
            train, model_type, training_date, draws, folds, seed, parallelism
        )
        training.save_model(model, lake.models)
        entries.append(training.registry_row(rows, model, training_date))
    stores.write_snapshots(stores.union_snapshots(entries), lake.registry, (monitoring.MODEL,))
    versions = [version_name(m, training_date) for m in training.model_types(model_types)]
    return spark.read.parquet(lake.registry).where(F.col(monitoring.MODEL).isin(versions))


def run_batch_training(
    spark: SparkSession, lake: Lake, dates: Sequence[str], **options
) -> DataFrame:
    """Train for several dates, one after the other; returns all their registry rows."""
    return stores.union_snapshots([run_training(spark, lake, d, **options) for d in dates])


def registered_models(spark: SparkSession, lake: Lake) -> DataFrame:
    """The registry, empty before the first training."""
    return stores.read_or_empty(spark, lake.registry, REGISTRY_KEY)


def run_scoring(
    spark: SparkSession, lake: Lake, start: str, end: str, versions: Sequence[str] | None = None
) -> DataFrame:
    """Score all snapshots of a span with the given versions, by default the newest of each type.

    Returns rows and success per version and snapshot.
    """
    if versions is None:
        newest = latest_versions(registered_models(spark, lake))
        versions = [row[monitoring.MODEL] for row in newest.collect()]
    if not versions:
        raise ValueError("no trained model to score with")
    features = spark.read.parquet(lake.features)
    scored = [
        score_window(features, load_model(f"{lake.models}/models/{v}"), v, start, end)
        for v in versions
    ]
    stores.write_predictions(stores.union_snapshots(scored), lake.predictions)
    written = spark.read.parquet(lake.predictions)
    calendar = month_calendar(spark, start, end).drop("months_since_start")
    reports = [
        stores.backfill_report(
            written.where(F.col(monitoring.MODEL) == v), calendar
        ).withColumn(monitoring.MODEL, F.lit(v))
        for v in versions
    ]
    return stores.union_snapshots(reports)


def run_monitoring(
    spark: SparkSession, lake: Lake, start: str, end: str, match_on_date: bool = False
) -> DataFrame:
    """Metrics and alerts of every model with scores in the span; returns one summary row each."""
    scores = checkpointed(
        monitoring.monitored_scores(
            spark.read.parquet(lake.predictions),
            stores.read_or_empty(spark, lake.labels, LABEL_STORE_SCHEMA),
            start,
            end,
            match_on_date,
        )
    )
    profile = checkpointed(monitoring.period_profile(scores))
    metrics = monitoring.performance_over_time(profile)
    shift = monitoring.score_shift(scores)
    stability = checkpointed(
        monitoring.overall_stability(monitoring.stability_measures(profile), shift)
    )
    alerts = checkpointed(
        monitoring.performance_alerts(metrics, stability, registered_models(spark, lake))
    )
    stores.write_monitoring(metrics, alerts, lake.monitoring, end)
    return monitoring.monitoring_summary(metrics, stability, alerts)
