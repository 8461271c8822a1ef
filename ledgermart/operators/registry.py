"""Model registry: one row per trained model version, and the choices made from it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .monitoring import DATE, LABEL, MODEL, SCORE, auc_by_split

VERSION_PATTERN = r"^credit_model_(.+)_(\d{4}_\d{2}_\d{2})$"
SPLITS = ("train", "test", "oot")


def version_name(model_type: str, training_date: str) -> str:
    return f"credit_model_{model_type}_{training_date.replace('-', '_')}"


def with_version_parts(registry: DataFrame) -> DataFrame:
    """Add the model type and training date that a version name spells out."""
    date_part = F.regexp_extract(MODEL, VERSION_PATTERN, 2)
    return registry.withColumns(
        {
            "model_type": F.regexp_extract(MODEL, VERSION_PATTERN, 1),
            "training_date": F.try_to_date(F.translate(date_part, "_", "-"), "yyyy-MM-dd"),
        }
    )


def latest_versions(registry: DataFrame) -> DataFrame:
    """The newest version of every model type."""
    dated = with_version_parts(registry.select(MODEL)).where(F.col("training_date").isNotNull())
    return dated.groupBy("model_type").agg(
        F.max_by(MODEL, "training_date").alias(MODEL),
        F.max("training_date").alias("training_date"),
    )


def best_model(registry: DataFrame, metric: str = "auc_test") -> DataFrame:
    """The version with the highest value of a metric; the first name wins a tie."""
    measured = registry.where(F.col(metric).isNotNull())
    return measured.orderBy(F.desc(metric), MODEL).limit(1).select(MODEL, metric)


def with_span(df: DataFrame, spans: Mapping[str, tuple[str, str]], date: str = DATE) -> DataFrame:
    """Add the name of the inclusive date span a row falls in, as ``split``."""
    split: Column | None = None
    for name, (start, end) in spans.items():
        inside = F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        split = F.when(inside, name) if split is None else split.when(inside, name)
    return df.withColumn("split", split)


def metrics_by_split(scored: DataFrame) -> DataFrame:
    """AUC and Gini of train, test and out-of-time rows side by side, one row per model."""
    measured = auc_by_split(scored, [MODEL, "split"], SCORE, LABEL)
    columns = [
        F.max(F.when(F.col("split") == split, F.col(metric))).alias(f"{metric}_{split}")
        for metric in ("auc", "gini")
        for split in SPLITS
    ]
    return measured.groupBy(MODEL).agg(*columns)


def baseline_from_scores(
    scores: DataFrame, spans: Mapping[str, tuple[str, str]], feature_count: int
) -> DataFrame:
    """Registry rows of models known only by their scores."""
    spanned = with_span(scores, spans).where(F.col("split").isNotNull())
    dated = with_version_parts(metrics_by_split(spanned))
    return dated.withColumn("feature_count", F.lit(feature_count))


def validation_report(scored: DataFrame) -> DataFrame:
    """Re-scored rows per model: AUC, and mean and population deviation of the scores."""
    moments = scored.groupBy(MODEL).agg(
        F.count("*").alias("rows"),
        F.avg(SCORE).alias("mean_probability"),
        F.stddev_pop(SCORE).alias("std_probability"),
    )
    auc = auc_by_split(scored, [MODEL], SCORE, LABEL).drop("gini")
    return moments.join(auc, MODEL, "left").withColumnRenamed("auc", "auc_score")
