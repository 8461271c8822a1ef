"""Monthly run calendar and the date rules of training, scoring and monitoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import month_number, month_start


def months_between_bounds(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """First-of-month dates from ``start`` to ``end`` (columns of a one-row frame), both included.

    ``months_since_start`` numbers them from 0.
    """
    first = month_start(F.col(start))
    months = F.expr("sequence(first, last, interval 1 month)")
    return (
        bounds.select(first.alias("first"), F.greatest(first, F.col(end).cast("date")).alias("last"))
        .select(F.posexplode(months).alias("months_since_start", "snapshot_date"))
        .select("snapshot_date", "months_since_start")
    )


def month_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """First-of-month dates between two given dates."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return months_between_bounds(bounds, "start", "end")


def with_enough_history(calendar: DataFrame, lookback_months: int = 6) -> DataFrame:
    """Dates that have the whole lookback behind them."""
    return calendar.where(F.col("months_since_start") >= lookback_months)


@dataclass(frozen=True)
class TrainingWindow:
    """Date limits of one training run, all inclusive, as ISO text."""

    train_test_start: str
    train_test_end: str
    oot_start: str
    oot_end: str


def with_training_window(
    runs: DataFrame, date: str = "snapshot_date", train_months: int = 12, oot_months: int = 2
) -> DataFrame:
    """Add the train/test and out-of-time limits that belong to a training date."""
    day = F.col(date)
    oot_start = F.add_months(day, -oot_months)
    return runs.withColumns(
        {
            "train_test_start": F.add_months(oot_start, -train_months),
            "train_test_end": F.date_sub(oot_start, 1),
            "oot_start": oot_start,
            "oot_end": F.date_sub(day, 1),
        }
    )


def training_window(
    spark: SparkSession, training_date: str, train_months: int = 12, oot_months: int = 2
) -> TrainingWindow:
    """The limits for one training date."""
    run = spark.range(1).select(F.lit(training_date).cast("date").alias("snapshot_date"))
    row = with_training_window(run, train_months=train_months, oot_months=oot_months).first()
    return TrainingWindow(
        str(row.train_test_start), str(row.train_test_end), str(row.oot_start), str(row.oot_end)
    )


def with_training_due(
    runs: DataFrame, first_training: str, every_months: int = 3, forced: bool = False
) -> DataFrame:
    """Add ``training_due``: months since the first training date divide by the interval."""
    first = F.lit(first_training).cast("date")
    elapsed = month_number(F.col("snapshot_date")) - month_number(first)
    due = (F.col("snapshot_date") >= first) & (F.pmod(elapsed, F.lit(every_months)) == 0)
    return runs.withColumn("training_due", F.lit(True) if forced else due)


def with_execution_path(
    runs: DataFrame, registry: DataFrame, first_training: str, monitoring: bool = True
) -> DataFrame:
    """Add what a run does: train first, only score with existing models, or just report.

    ``runs`` has ``training_due``; ``registry`` lists trained models with ``training_date``.  A
    model counts from its training date on.
    """
    first = F.lit(first_training).cast("date")
    first_model = registry.agg(F.min("training_date")).scalar()
    started = F.col("snapshot_date") >= first
    path = (
        F.when(~started, "skip_to_reporting")
        .when(F.col("training_due"), "training_start")
        .when(first_model <= F.col("snapshot_date"), "inference_only_start")
        .otherwise("skip_to_reporting")
    )
    return runs.withColumns(
        {
            "run_inference": started,
            "run_monitoring": started & F.lit(monitoring),
            "execution_path": path,
        }
    )


def with_monitoring_window(runs: DataFrame, days: int = 30) -> DataFrame:
    """Add the span of scores that a monitoring run looks at."""
    return runs.withColumns(
        {
            "monitoring_start": F.date_sub("snapshot_date", days),
            "monitoring_end": F.col("snapshot_date"),
        }
    )


def timeline_points(calendar: DataFrame) -> DataFrame:
    """The dates a quarter, half and three quarters through the calendar."""
    months = calendar.agg(F.count("*")).scalar()
    place = F.col("months_since_start")
    quarters = F.array(
        F.floor(months / 4), F.floor(months / 2), F.floor(3 * months / 4)
    )
    return calendar.where(F.array_contains(quarters, place.cast("bigint"))).select(
        F.col("snapshot_date").alias("analysis_date")
    )
