"""Performance, drift and stability of scores over time, and the alerts they raise.

``model_version`` is part of every key, so one job monitors any number of models.  Input is a
frame with ``model_version, snapshot_date, model_prediction_proba, model_prediction_binary,
actual_label`` (see ``monitored_scores``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import flag, iso_day
from ..functions.ordering import (
    auc_aggregate,
    class_counts,
    ks_statistic,
    ks_tail_probability,
    place_classes,
    quantile_parts,
    roc_auc,
)
from ..sources.stores import within

MODEL = "model_version"
DATE = "snapshot_date"
SCORE = "model_prediction_proba"
DECISION = "model_prediction_binary"
LABEL = "actual_label"
PERIOD = [MODEL, DATE]

HISTOGRAM_BINS = 10
# fixed values: edges of ten score bins as double-precision multiples of 0.1
SCORE_EDGES = [i * 0.1 for i in range(HISTOGRAM_BINS + 1)]


# --- input ---------------------------------------------------------------------------------------


def first_label_per_customer(labels: DataFrame) -> DataFrame:
    """The customer's earliest label; among loans of one date the smallest loan id decides."""
    earliest = W.partitionBy("Customer_ID").orderBy(DATE, "loan_id")
    return (
        labels.withColumn("_rank", F.row_number().over(earliest))
        .where("_rank = 1")
        .select("Customer_ID", F.col("label").alias(LABEL))
    )


def monitored_scores(
    predictions: DataFrame,
    labels: DataFrame,
    start: str | None = None,
    end: str | None = None,
    match_on_date: bool = False,
) -> DataFrame:
    """Scores with the outcome of their customer.

    Labels are matched by customer alone, the earliest one counting; ``match_on_date`` asks for
    the label of the score's own date instead.
    """
    dated = predictions.withColumn(DATE, iso_day(F.col(DATE)))
    dated = within(dated, start, end)
    if match_on_date:
        unique = W.partitionBy("Customer_ID", DATE).orderBy("loan_id")
        outcome = (
            labels.withColumn(DATE, iso_day(F.col(DATE)))
            .withColumn("_rank", F.row_number().over(unique))
            .where("_rank = 1")
            .select("Customer_ID", DATE, F.col("label").alias(LABEL))
        )
        return dated.join(outcome, ["Customer_ID", DATE])
    return dated.join(first_label_per_customer(labels), "Customer_ID")


# --- one row per model and date ------------------------------------------------------------------


def _ratio(numerator: Column, denominator: Column) -> Column:
    """Share that is 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def score_bin(score: Column) -> Column:
    """Index 0-9 of the score's bin: closed below, open above, the last one closed."""
    above = [F.when(score >= edge, 1).otherwise(0) for edge in SCORE_EDGES[1:-1]]
    inside = score.between(SCORE_EDGES[0], SCORE_EDGES[-1])
    return F.when(inside, reduce(Column.__add__, above))


def period_profile(scores: DataFrame) -> DataFrame:
    """Everything monitoring needs to know about a model's scores of one date.

    Counts by class and decision, score moments and bins come from one aggregate; AUC and
    quartiles share one ordered pass over the distinct scores.  The other operators work on this
    small frame; write or checkpoint it when several of them are wanted.
    """
    label, decision, score = F.col(LABEL), F.col(DECISION), F.col(SCORE)

    def cell(wanted_label: int, wanted_decision: int) -> Column:
        return F.count_if((label == wanted_label) & (decision == wanted_decision))

    counts = scores.withColumn("_bin", score_bin(score)).groupBy(*PERIOD).agg(
        F.count("*").alias("sample_count"),
        F.avg(label).alias("actual_default_rate"),
        F.avg(decision).alias("predicted_default_rate"),
        F.avg(score).alias("mean_prediction"),
        F.stddev_samp(score).alias("std_prediction"),
        F.min(score).alias("min_prediction"),
        F.max(score).alias("max_prediction"),
        cell(1, 1).alias("true_positives"),
        cell(0, 1).alias("false_positives"),
        cell(0, 0).alias("true_negatives"),
        cell(1, 0).alias("false_negatives"),
        F.array(*[F.count_if(F.col("_bin") == i) for i in range(HISTOGRAM_BINS)]).alias("bin_counts"),
    )
    placed = place_classes(class_counts(scores, PERIOD, SCORE, LABEL), PERIOD, SCORE)
    aggregates, quartiles = quantile_parts(
        score,
        F.col("positives") + F.col("negatives"),
        F.col("positives_before") + F.col("negatives_before"),
        F.col("positives_total") + F.col("negatives_total"),
        {"q25": 0.25, "q75": 0.75},
    )
    ordered = placed.groupBy(*PERIOD).agg(auc_aggregate().alias("auc"), *aggregates)
    return counts.join(ordered.select(*PERIOD, "auc", *quartiles), PERIOD, "left")


# --- performance ---------------------------------------------------------------------------------


def performance_over_time(profile: DataFrame, min_rows: int = 10) -> DataFrame:
    """Confusion counts, rates, AUC and score moments per model and date.

    Dates with fewer rows, or where labels and decisions together know one class only, are left
    out.  AUC is NULL when all labels are equal.
    """
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    samples = F.col("sample_count")
    kept = profile.where((samples >= min_rows) & (samples > tp) & (samples > F.col("true_negatives")))
    p, r = F.col("precision"), F.col("recall")
    measured = kept.withColumns({"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn)})
    return measured.select(
        *PERIOD,
        "sample_count",
        "actual_default_rate",
        "predicted_default_rate",
        "auc",
        (2 * F.col("auc") - 1).alias("gini"),
        "precision",
        "recall",
        _ratio(2 * p * r, p + r).alias("f1_score"),
        "mean_prediction",
        "std_prediction",
        "true_positives",
        "false_positives",
        "true_negatives",
        "false_negatives",
    )


def auc_by_split(scored: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """AUC and Gini per group, such as the train, test and out-of-time splits of a model."""
    return roc_auc(scored, keys, score, label).withColumn("gini", 2 * F.col("auc") - 1)


def stability_measures(profile: DataFrame, min_rows: int = 10) -> DataFrame:
    """One row per model, from one pass over its dates: drift of scores, AUC and distribution.

    AUC counts only on dates with enough rows.
    """
    enough = F.col("sample_count") >= min_rows
    auc = F.when(enough, F.col("auc"))
    return with_stability_index(profile).groupBy(MODEL).agg(
        F.count("*").alias("num_periods"),
        F.stddev_samp("mean_prediction").alias("mean_drift"),
        F.stddev_samp("std_prediction").alias("std_drift"),
        F.count_if(enough).alias("auc_periods"),
        F.stddev_samp(auc).alias("auc_deviation"),
        F.avg(auc).alias("auc_mean"),
        F.coalesce(F.avg("psi"), F.lit(0.0)).alias("avg_prediction_psi"),
    )


def _auc_is_steady() -> Column:
    return flag((F.col("auc_periods") < 2) | (F.col("auc_deviation") < 0.05))


def _scores_are_steady() -> Column:
    return flag((F.col("mean_drift") < 0.05) & (F.col("ks_statistic") < 0.1))


def model_stability(measures: DataFrame) -> DataFrame:
    """How steady a model's AUC is; fewer than two measured dates count as perfectly stable."""
    single = F.col("auc_periods") < 2
    deviation, mean = F.col("auc_deviation"), F.col("auc_mean")
    consistency = F.when(mean > 0, 1 - deviation / mean).otherwise(0.0)
    return measures.select(
        MODEL,
        F.col("auc_periods").alias("periods"),
        F.when(single, 0.0).otherwise(deviation).alias("performance_volatility"),
        F.when(single, 1.0).otherwise(consistency).alias("consistency_score"),
        _auc_is_steady().alias("is_stable"),
    )


# --- score distribution --------------------------------------------------------------------------


def score_statistics(profile: DataFrame) -> DataFrame:
    """Mean, deviation, range and quartiles of the scores per model and date."""
    renamed = [F.col(f"{name}_prediction").alias(name) for name in ("mean", "std", "min", "max")]
    return profile.select(*PERIOD, *renamed, "q25", "q75")


def first_and_last_period(scores: DataFrame) -> DataFrame:
    """First and last date of every model, and the number of dates."""
    return (
        scores.select(*PERIOD)
        .distinct()
        .groupBy(MODEL)
        .agg(
            F.min(DATE).alias("first_date"),
            F.max(DATE).alias("last_date"),
            F.count("*").alias("periods"),
        )
    )


def score_shift(scores: DataFrame) -> DataFrame:
    """Kolmogorov-Smirnov distance between a model's first and last date; 0 for a single date."""
    ends = first_and_last_period(scores)
    compared = (
        scores.select(*PERIOD, SCORE)
        .join(ends.where("periods > 1"), MODEL)
        .where(F.col(DATE).isin(F.col("first_date"), F.col("last_date")))
        .withColumn("is_last", F.col(DATE) == F.col("last_date"))
    )
    distance = ks_statistic(compared, [MODEL], SCORE, "is_last")
    p_value = ks_tail_probability(
        F.col("ks_statistic"), F.col("first_size"), F.col("second_size")
    )
    return ends.join(distance, MODEL, "left").select(
        MODEL,
        "periods",
        "first_date",
        "last_date",
        F.coalesce("ks_statistic", F.lit(0.0)).alias("ks_statistic"),
        F.coalesce(p_value, F.lit(1.0)).alias("ks_p_value"),
    )


def prediction_stability(measures: DataFrame, shift: DataFrame) -> DataFrame:
    """Drift of score means and deviations over time next to the first-to-last ``score_shift``."""
    return measures.join(shift, MODEL).select(
        MODEL,
        "mean_drift",
        "std_drift",
        "ks_statistic",
        "ks_p_value",
        _scores_are_steady().alias("is_stable"),
    )


def bin_shares(counts: str) -> Column:
    """Shares that belong to an array of counts."""
    whole = F.aggregate(counts, F.lit(0).cast("bigint"), lambda total, n: total + n)
    return F.transform(counts, lambda n: F.try_divide(n, whole))


def score_histogram(profile: DataFrame) -> DataFrame:
    """Count and share of every occupied score bin per model and date."""
    cells = F.arrays_zip(F.col("bin_counts").alias("count"), bin_shares("bin_counts").alias("share"))
    return (
        profile.select(*PERIOD, F.posexplode(cells).alias("bin", "cell"))
        .select(*PERIOD, "bin", "cell.count", "cell.share")
        .where("count > 0")
    )


def with_stability_index(profile: DataFrame) -> DataFrame:
    """Add the population stability index against the model's first date; NULL on that date.

    Bins that are empty on either side do not count.
    """
    by_date = W.partitionBy(MODEL).orderBy(DATE)
    shared = profile.withColumn("_shares", bin_shares("bin_counts"))
    based = shared.withColumns(
        {"_base": F.first("_shares").over(by_date), "_number": F.row_number().over(by_date)}
    )

    def term(now: Column, base: Column) -> Column:
        return F.when((now > 0) & (base > 0), (now - base) * F.ln(now / base)).otherwise(0.0)

    index = F.aggregate(F.zip_with("_shares", "_base", term), F.lit(0.0), lambda total, x: total + x)
    return based.withColumn("psi", F.when(F.col("_number") > 1, index)).drop(
        "_shares", "_base", "_number"
    )


def population_stability(profile: DataFrame) -> DataFrame:
    """Population stability index of every later date."""
    return with_stability_index(profile).where(F.col("psi").isNotNull()).select(*PERIOD, "psi")


def prediction_patterns(measures: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Mean stability index over the later dates of every model; 0 for a single date."""
    psi = F.col("avg_prediction_psi")
    return measures.select(
        MODEL, "num_periods", psi, (psi > threshold).alias("has_significant_drift")
    )


def overall_stability(
    measures: DataFrame, shift: DataFrame, threshold: float = 0.2
) -> DataFrame:
    """Share of the three checks a model passes, and the verdict."""
    psi = F.col("avg_prediction_psi")
    checks = {
        "prediction_stable": _scores_are_steady(),
        "performance_stable": _auc_is_steady(),
        "distribution_stable": psi < threshold,
    }
    judged = measures.join(shift.select(MODEL, "ks_statistic"), MODEL).select(
        MODEL, "ks_statistic", psi, *[check.alias(name) for name, check in checks.items()]
    )
    passed = reduce(Column.__add__, [F.col(name).cast("int") for name in checks])
    judged = judged.withColumn("stability_score", passed / F.lit(3.0))
    verdict = (
        F.when(F.col("stability_score") >= 0.8, "STABLE")
        .when(F.col("stability_score") >= 0.6, "MODERATE")
        .otherwise("UNSTABLE")
    )
    return judged.withColumns(
        {"assessment": verdict, "prediction_stability_score": 1 - F.least(psi, F.lit(1.0))}
    )


def drift_classes(stability: DataFrame) -> DataFrame:
    """Every drift measure of a model with its class: high above 0.2, moderate above 0.1."""
    measures = ["overall_prediction_drift", "prediction_stability_score"]
    wide = stability.select(MODEL, F.col("avg_prediction_psi").alias(measures[0]), measures[1])
    value = F.col("value")
    level = F.when(value > 0.2, "high").when(value > 0.1, "moderate").otherwise("low")
    return wide.unpivot(MODEL, measures, "measure", "value").withColumn("drift", level)


# --- alerts and summary --------------------------------------------------------------------------


def _percent(c: Column) -> Column:
    return F.format_string("%.1f", c)


def performance_alerts(
    metrics: DataFrame,
    stability: DataFrame,
    baseline: DataFrame,
    critical_drop: float = 0.10,
    warning_drop: float = 0.05,
) -> DataFrame:
    """Alerts on AUC loss, instability, score shift and low volume, most severe first.

    ``metrics`` comes from ``performance_over_time``, ``stability`` from ``overall_stability``,
    ``baseline`` has ``model_version, auc_oot``.
    """
    day, auc = F.col(DATE).alias("date"), F.col("auc")
    drop = (F.col("auc_oot") - auc) / F.col("auc_oot")
    dropped = metrics.join(baseline.select(MODEL, "auc_oot"), MODEL).withColumn("_drop", drop)
    loss = F.col("_drop") * 100
    is_critical = F.col("_drop") >= critical_drop
    degradation = dropped.where(F.col("_drop") >= warning_drop).select(
        MODEL,
        F.lit("performance_degradation").alias("type"),
        F.when(is_critical, "critical").otherwise("warning").alias("severity"),
        F.lit("auc").alias("metric"),
        day,
        auc.alias("value"),
        F.col("auc_oot").alias("baseline"),
        loss.alias("degradation_pct"),
        F.when(is_critical, F.concat(F.lit("Critical AUC degradation: "), _percent(loss), F.lit("% drop from baseline")))
        .otherwise(F.concat(F.lit("AUC degradation warning: "), _percent(loss), F.lit("% drop from baseline")))
        .alias("message"),
    )

    volume = metrics.groupBy(MODEL).agg(
        F.max(DATE).alias(DATE),
        F.max_by("sample_count", DATE).alias("recent"),
        F.avg("sample_count").alias("usual"),
    )
    verdict, score, ks = F.col("assessment"), F.col("stability_score"), F.col("ks_statistic")
    recent, usual = F.col("recent"), F.col("usual")

    def alert(condition, kind, severity, metric, value, baseline, message) -> Column:
        nothing = F.lit(None).cast("double")
        return F.when(
            condition,
            F.struct(
                F.lit(kind).alias("type"),
                severity.alias("severity"),
                F.lit(metric).alias("metric"),
                day,
                value.cast("double").alias("value"),
                (nothing if baseline is None else baseline).alias("baseline"),
                nothing.alias("degradation_pct"),
                message.alias("message"),
            ),
        )

    warning = F.lit("warning")
    per_model = F.array(
        alert(
            verdict.isin("UNSTABLE", "MODERATE"),
            "stability",
            F.when(verdict == "UNSTABLE", "critical").otherwise(warning),
            "stability_score",
            score,
            None,
            F.concat(
                F.lit("Model stability is "),
                F.lower(verdict),
                F.format_string(" (score: %.2f)", score),
            ),
        ),
        alert(
            ks >= 0.15,
            "distribution_drift",
            warning,
            "ks_statistic",
            ks,
            None,
            F.format_string("Prediction distribution drift detected (KS: %.3f)", ks),
        ),
        alert(
            recent < usual * 0.5,
            "sample_volume",
            warning,
            "sample_count",
            recent,
            usual,
            F.format_string("Low prediction volume: %d vs avg %.0f", recent, usual),
        ),
    )
    others = stability.join(volume, MODEL).select(MODEL, F.inline(F.array_compact(per_model)))
    return by_severity(degradation.unionByName(others))


def by_severity(alerts: DataFrame) -> DataFrame:
    """Alerts ordered by severity, then date."""
    rank = (
        F.when(F.col("severity") == "critical", 0)
        .when(F.col("severity") == "warning", 1)
        .when(F.col("severity") == "info", 2)
        .otherwise(3)
    )
    return alerts.orderBy(rank, "date")


def monitoring_summary(metrics: DataFrame, stability: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row per model: AUC over the periods, verdict, alerts by severity and what to do."""
    auc = metrics.groupBy(MODEL).agg(
        F.count("*").alias("periods_analyzed"),
        F.avg("auc").alias("avg_auc"),
        F.min("auc").alias("min_auc"),
        F.max("auc").alias("max_auc"),
        F.stddev_samp("auc").alias("auc_volatility"),
    )
    raised = alerts.groupBy(MODEL).agg(
        F.count("*").alias("total_alerts"),
        F.count_if(F.col("severity") == "critical").alias("critical_alerts"),
        F.count_if(F.col("severity") == "warning").alias("warning_alerts"),
    )
    joined = (
        auc.join(stability.select(MODEL, "stability_score", "assessment"), MODEL, "left")
        .join(raised, MODEL, "left")
        .fillna(0, ["total_alerts", "critical_alerts", "warning_alerts"])
    )
    critical, verdict = F.col("critical_alerts"), F.col("assessment")
    advice = F.concat_ws(
        "; ",
        F.when(critical > 0, "Critical performance degradation detected: act now"),
        F.when(verdict == "UNSTABLE", "Consider retraining the unstable model"),
        F.when((verdict == "STABLE") & (critical == 0), "Performance is stable: continue monitoring"),
    )
    return joined.withColumn("recommendation", advice)


def trend_chart(metrics: DataFrame, statistics: DataFrame) -> DataFrame:
    """What the monitoring charts show per date: AUC, volume, rates and score quartiles."""
    return metrics.select(
        *PERIOD, "auc", "gini", "sample_count", "actual_default_rate", "predicted_default_rate"
    ).join(statistics.select(*PERIOD, "mean", "std", "q25", "q75"), PERIOD)


def baseline_metrics(registry: DataFrame, version: str) -> DataFrame:
    """Training metrics of one model version from the registry."""
    return registry.where(F.col(MODEL) == version).select(
        MODEL, "auc_train", "auc_test", "auc_oot", "gini_train", "gini_test", "gini_oot",
        "training_date", "feature_count",
    )
