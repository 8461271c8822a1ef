"""One scheduled month: stores, then training or scoring as the date asks for, then the report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import health
from ..operators.calendar import (
    month_calendar,
    with_execution_path,
    with_monitoring_window,
    with_training_due,
)
from ..operators.monitoring import MODEL
from ..session import checkpointed
from ..sources import stores
from ..sources.schemas import LABEL_STORE_SCHEMA
from . import medallion, models
from .lake import Lake


def planned_run(
    spark: SparkSession,
    lake: Lake,
    date: str,
    first_training: str,
    every_months: int = 3,
    forced: bool = False,
    monitoring: bool = True,
) -> Row:
    """What the run of one date has to do, as one row."""
    runs = with_training_due(month_calendar(spark, date, date), first_training, every_months, forced)
    registry = models.registered_models(spark, lake)
    planned = with_execution_path(runs, registry, first_training, monitoring)
    return with_monitoring_window(planned).first()


def run_month(
    spark: SparkSession,
    lake: Lake,
    raw: Mapping[str, str],
    date: str,
    history_start: str,
    first_training: str,
    every_months: int = 3,
    forced: bool = False,
    monitoring: bool = True,
    landed: bool = False,
    **training_options,
) -> DataFrame:
    """Run one month and store its report row; with ``landed`` only new files of the raw folders are read."""
    medallion.run_medallion(spark, lake, raw, date, date, history_start=history_start, landed=landed)
    plan = planned_run(spark, lake, date, first_training, every_months, forced, monitoring)
    trains = plan.execution_path == "training_start"
    works = plan.execution_path != "skip_to_reporting"
    trained = models.run_training(spark, lake, date, **training_options) if trains else None
    scored = models.run_scoring(spark, lake, date, date) if works else None
    watched = works and plan.run_monitoring
    summary = None
    if watched:
        summary = models.run_monitoring(
            spark, lake, str(plan.monitoring_start), str(plan.monitoring_end)
        )
    report = health.run_report(
        checkpointed(_sections(spark, lake, date, trained, scored, summary))
    )
    dated = report.withColumn("snapshot_date", F.col("run_date"))
    stores.write_snapshots(dated, lake.reports)
    return stores.read_store(spark, lake.reports, date, date)


def _run(spark: SparkSession, date: str) -> DataFrame:
    return spark.range(1).select(F.lit(date).cast("date").alias("run_date"))


def _sections(spark, lake, date, trained, scored, summary) -> DataFrame:
    run = _run(spark, date)
    day = F.lit(date).cast("date").alias("run_date")
    features = stores.read_or_empty(
        spark, lake.features, "feature_snapshot_date date, data_completeness_score double"
    )
    features = stores.within(features, date, date, "feature_snapshot_date")
    labels = stores.read_or_empty(spark, lake.labels, LABEL_STORE_SCHEMA)
    labels = stores.within(labels, date, date)
    available = F.col("rows") > 0
    validated = features.agg(
        F.count("*").alias("rows"), F.avg("data_completeness_score").alias("feature_completeness")
    ).select(
        day,
        "feature_completeness",
        labels.agg(F.avg("label")).scalar().alias("default_rate"),
        F.coalesce("feature_completeness", F.lit(0.0)).alias("overall_score"),
        available.alias("validation_passed"),
        F.when(available, "success").otherwise("failed").alias("overall_status"),
    )
    parts = [health.validation_section(validated)]
    names = F.array_sort(F.collect_list(MODEL))
    if trained is None:
        training = run.select(
            "run_date",
            F.lit(False).alias("training_executed"),
            F.lit(False).alias("success"),
            F.array().cast("array<string>").alias("models_trained"),
            F.lit(None).cast("string").alias("error"),
        )
    else:
        training = trained.agg(names.alias("models_trained")).select(
            day,
            F.lit(True).alias("training_executed"),
            (F.size("models_trained") > 0).alias("success"),
            "models_trained",
            F.lit(None).cast("string").alias("error"),
        )
    parts.append(health.training_section(training))
    if scored is not None:
        ok = F.col("success")
        scoring = scored.agg(
            F.array_sort(F.collect_list(F.when(ok, F.col(MODEL)))).alias("successful_models"),
            F.array_sort(F.collect_list(F.when(~ok, F.col(MODEL)))).alias("failed_models"),
            F.avg(ok.cast("int")).alias("success_rate"),
        )
        parts.append(health.inference_section(scoring.select(day, "*")))
    else:
        nothing = health.inference_section(
            spark.createDataFrame(
                [],
                "run_date date, successful_models array<string>, failed_models array<string>, "
                "success_rate double",
            )
        )
        parts.append(health.with_missing_runs(nothing, run, "model_inference"))
    if summary is not None:
        watched = summary.agg(
            names.alias("models_monitored"),
            _named(F.col("critical_alerts") > 0).alias("critical_alerts"),
            _named(F.col("warning_alerts") > 0).alias("warning_alerts"),
        )
        monitored = watched.select(day, F.lit(True).alias("monitoring_executed"), "*")
    else:
        empty = F.array().cast("array<string>")
        monitored = run.select(
            "run_date",
            F.lit(False).alias("monitoring_executed"),
            empty.alias("models_monitored"),
            empty.alias("critical_alerts"),
            empty.alias("warning_alerts"),
        )
    parts.append(health.monitoring_section(monitored))
    return health.combine_sections(*parts)


def _named(condition: Column) -> Column:
    """Versions of the models for which the condition holds."""
    return F.array_sort(F.collect_list(F.when(condition, F.col(MODEL))))
