"""Health of a run: verdict per component, overall score, recommendations, severity.

Every component frame has one row per ``run_date``.  A section is
``run_date, section, status, summary, insights, concerns``; four sections make a run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: score of every status, limits, and texts of the report
STATUS_SCORES = {
    "excellent": 1.0,
    "success": 1.0,
    "healthy": 1.0,
    "good": 0.8,
    "partial_success": 0.6,
    "warnings": 0.6,
    "warning": 0.4,
    "failed": 0.2,
    "critical_issues": 0.2,
    "critical": 0.0,
    "no_data": 0.0,
    "analysis_error": 0.0,
    "skipped": 0.7,
}
UNKNOWN_SCORE = 0.3
ISSUE_STATUSES = ("critical", "failed", "critical_issues")
ACHIEVEMENT_STATUSES = ("excellent", "success", "healthy")
SECTIONS = ("data_validation", "model_training", "model_inference", "model_monitoring")
NOT_RUN = {
    "data_validation": ("No data validation results available", "Data validation task did not execute"),
    "model_training": ("No training results available", "Training task did not execute"),
    "model_inference": ("No inference results available", "Inference task did not execute"),
    "model_monitoring": ("No monitoring results available", "Monitoring task did not execute"),
}
FIRST_ACTION = "Investigate pipeline failures before next execution"
ACTIONS_BY_CONCERN = {
    "data validation": "Fix data quality issues in feature and label stores",
    "training": "Review training process and address model training failures",
    "inference": "Check model artifacts and inference pipeline integrity",
}
SHORT_TERM = [
    "Implement automated alerting for pipeline failures",
    "Add more comprehensive monitoring metrics",
    "Review and optimize resource allocation",
]
LONG_TERM = [
    "Consider implementing A/B testing for model deployments",
    "Explore automated model retraining triggers",
    "Implement advanced feature engineering techniques",
    "Consider model ensemble strategies for improved performance",
]
LISTED = 5


def _texts(*items: Column) -> Column:
    """The given texts without the missing ones."""
    return F.array_compact(F.array(*items))


def _nothing() -> Column:
    return F.array().cast("array<string>")


def _section(rows: DataFrame, name: str, status, summary, insights=None, concerns=None) -> DataFrame:
    return rows.select(
        "run_date",
        F.lit(name).alias("section"),
        status.alias("status"),
        summary.alias("summary"),
        (_nothing() if insights is None else insights).alias("insights"),
        (_nothing() if concerns is None else concerns).alias("concerns"),
    )


def with_missing_runs(section: DataFrame, runs: DataFrame, name: str) -> DataFrame:
    """A section for every run; one that has no result reads ``no_data``."""
    summary, concern = NOT_RUN[name]
    absent = runs.select("run_date").join(section, "run_date", "left_anti")
    filled = _section(
        absent, name, F.lit("no_data"), F.lit(summary), concerns=F.array(F.lit(concern))
    )
    return section.unionByName(filled)


# --- components ----------------------------------------------------------------------------------


def validation_section(results: DataFrame) -> DataFrame:
    """Data validation: ``overall_status, overall_score, validation_passed, feature_completeness,
    default_rate``; the last two may be NULL for a store that was not looked at."""
    complete, rate = F.col("feature_completeness"), F.col("default_rate")
    usual = rate.between(0.01, 0.15)
    verdict = F.when(F.col("validation_passed"), "passed").otherwise("failed")
    return _section(
        results,
        "data_validation",
        F.coalesce("overall_status", F.lit("unknown")),
        F.format_string("Data validation %s with score %.2f", verdict, "overall_score"),
        _texts(
            F.when(complete >= 0.8, "Feature store quality is acceptable"),
            F.when(
                usual, F.format_string("Label distribution is balanced (default rate: %.3f)", rate)
            ),
        ),
        _texts(
            F.when(complete < 0.8, F.format_string("Feature completeness low: %.2f", complete)),
            F.when(~usual, F.format_string("Unusual default rate detected: %.3f", rate)),
        ),
    )


def training_section(results: DataFrame) -> DataFrame:
    """Training: ``training_executed, success, models_trained, error``."""
    executed, success = F.col("training_executed"), F.col("success")
    error = F.coalesce("error", F.lit("Unknown error"))
    models = F.col("models_trained")
    summary = (
        F.when(~executed, "Training was skipped - using existing models")
        .when(success, F.format_string("Successfully trained %d models", F.size(models)))
        .otherwise(F.concat(F.lit("Training failed: "), error))
    )
    return _section(
        results,
        "model_training",
        F.when(~executed, "skipped").when(success, "success").otherwise("failed"),
        summary,
        _texts(
            F.when(~executed, "Training skipped according to schedule").when(
                success, F.concat(F.lit("Models trained: "), F.array_join(models, ", "))
            )
        ),
        _texts(F.when(executed & ~success, F.concat(F.lit("Training error: "), error))),
    )


def inference_section(results: DataFrame) -> DataFrame:
    """Scoring: ``successful_models, failed_models, success_rate``."""
    good, bad, rate = F.col("successful_models"), F.col("failed_models"), F.col("success_rate")
    level = F.when(rate >= 0.8, "highly successful").when(rate >= 0.5, "partially successful")
    return _section(
        results,
        "model_inference",
        F.when(rate >= 0.8, "excellent").when(rate >= 0.5, "partial_success").otherwise("failed"),
        F.format_string(
            "Inference %s: %d/%d models",
            F.coalesce(level, F.lit("largely failed")),
            F.size(good),
            F.size(good) + F.size(bad),
        ),
        _texts(
            F.when(
                F.size(good) > 0,
                F.concat(F.lit("Successfully processed models: "), F.array_join(good, ", ")),
            )
        ),
        _texts(
            F.when(F.size(bad) > 0, F.concat(F.lit("Failed models: "), F.array_join(bad, ", ")))
        ),
    )


def monitoring_section(results: DataFrame) -> DataFrame:
    """Monitoring: ``monitoring_executed, models_monitored, critical_alerts, warning_alerts``."""
    executed = F.col("monitoring_executed")
    critical, warning = F.col("critical_alerts"), F.col("warning_alerts")
    has_critical, has_warning = F.size(critical) > 0, F.size(warning) > 0

    def named(prefix: str, alerts: Column) -> Column:
        return F.transform(alerts, lambda alert: F.concat(F.lit(prefix), alert))

    return _section(
        results,
        "model_monitoring",
        F.when(~executed, "skipped")
        .when(has_critical, "critical_issues")
        .when(has_warning, "warnings")
        .otherwise("healthy"),
        F.when(~executed, "Monitoring was skipped")
        .when(has_critical, F.format_string("Critical issues detected in %d cases", F.size(critical)))
        .when(has_warning, F.format_string("Warnings detected for %d models", F.size(warning)))
        .otherwise(
            F.format_string("All %d models are performing well", F.size("models_monitored"))
        ),
        _texts(
            F.when(
                executed & ~has_critical & ~has_warning,
                "No performance or stability issues detected",
            )
        ),
        F.when(executed & has_critical, named("Critical: ", critical))
        .when(executed & has_warning, named("Warning: ", warning))
        .otherwise(_nothing()),
    )


# --- the whole run -------------------------------------------------------------------------------


def status_score(status: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in STATUS_SCORES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, status), F.lit(UNKNOWN_SCORE))


def combine_sections(*sections: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, sections)


def _in_section_order(value: Column) -> Column:
    """Values of a run's four sections, section after section."""
    place = F.array_position(F.array(*map(F.lit, SECTIONS)), F.col("section"))
    ordered = F.array_sort(F.collect_list(F.struct(place.alias("place"), value.alias("value"))))
    return F.transform(ordered, lambda entry: entry["value"])


def _mean_in_order(scores: Column) -> Column:
    """Mean summed in section order: a limit such as 0.4 is decided by the last digit."""
    total = F.aggregate(scores, F.lit(0.0), lambda total, score: total + score)
    return total / F.size(scores)


def executive_summary(sections: DataFrame) -> DataFrame:
    """Health score, verdict, impact and the first achievements and issues of every run."""
    status = F.col("status")
    issues = F.when(status.isin(*ISSUE_STATUSES), F.col("concerns")).otherwise(_nothing())
    wins = F.when(status.isin(*ACHIEVEMENT_STATUSES), F.col("insights")).otherwise(_nothing())
    runs = sections.groupBy("run_date").agg(
        _mean_in_order(_in_section_order(status_score(status))).alias("health_score"),
        F.slice(F.flatten(_in_section_order(wins)), 1, LISTED).alias("key_achievements"),
        F.slice(F.flatten(_in_section_order(issues)), 1, LISTED).alias("priority_issues"),
    )
    score = F.col("health_score")

    def banded(*names: str) -> Column:
        limits = F.when(score >= 0.8, names[0]).when(score >= 0.6, names[1])
        return limits.when(score >= 0.4, names[2]).otherwise(names[3])

    return runs.withColumns(
        {
            "pipeline_status": banded("excellent", "good", "concerning", "critical"),
            "business_impact": banded("positive", "neutral", "at_risk", "negative"),
        }
    )


def recommendations(sections: DataFrame, summary: DataFrame) -> DataFrame:
    """What to do now, soon and later, and how urgent it is."""
    concerns = sections.groupBy("run_date").agg(
        F.flatten(_in_section_order(F.col("concerns"))).alias("_concerns")
    )
    judged = summary.select("run_date", "pipeline_status").join(concerns, "run_date")
    status, found = F.col("pipeline_status"), F.col("_concerns")
    urgent = status.isin("critical", "concerning")

    def mentioned(words: str) -> Column:
        return F.exists(found, lambda text: F.lower(text).contains(words))

    actions = [
        F.when(urgent & mentioned(words), action) for words, action in ACTIONS_BY_CONCERN.items()
    ]
    many = F.size(found)
    return judged.select(
        "run_date",
        F.when(many > 5, "high")
        .when(many > 2, "medium")
        .when(urgent, "high")
        .otherwise("low")
        .alias("priority_level"),
        _texts(F.when(urgent, FIRST_ACTION), *actions).alias("immediate_actions"),
        F.when(status.isin("good", "concerning"), F.array(*map(F.lit, SHORT_TERM)))
        .otherwise(_nothing())
        .alias("short_term_improvements"),
        F.array(*map(F.lit, LONG_TERM)).alias("long_term_optimizations"),
    )


def severity(status: Column, score: Column, issues: Column) -> Column:
    """How a finished run is announced."""
    return (
        F.when(status.isin("critical", "report_generation_failed"), "failure")
        .when((status == "concerning") | (score < 0.5), "critical")
        .when(status.isin("good", "warnings") | (F.size(issues) > 0), "warning")
        .when(status == "excellent", "success")
        .otherwise("warning")
    )


def run_report(sections: DataFrame) -> DataFrame:
    """One row per run: section verdicts, summary, recommendations and severity."""
    verdicts = sections.groupBy("run_date").agg(
        F.count("*").alias("components"),
        *[
            F.max(F.when(F.col("section") == name, F.col("status"))).alias(f"{name}_status")
            for name in SECTIONS
        ],
    )
    summary = executive_summary(sections)
    report = verdicts.join(summary, "run_date").join(recommendations(sections, summary), "run_date")
    level = severity(F.col("pipeline_status"), F.col("health_score"), F.col("priority_issues"))
    return report.withColumn("severity", level)
