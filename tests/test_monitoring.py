import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgermart.operators import health as h
from ledgermart.operators import monitoring as m

SCHEMA = (
    "model_version string, snapshot_date date, model_prediction_proba double, "
    "model_prediction_binary int, actual_label int"
)
MARCH, APRIL = dt.date(2024, 3, 1), dt.date(2024, 4, 1)


def frame(spark, rows):
    full = [(v, d, s, int(s >= 0.5), y) for v, d, s, y in rows]
    return spark.createDataFrame(full, SCHEMA)


def test_exact_bin_edges(spark):
    values = [0.0, 0.3, 0.30000000000000004, 0.6, 0.1, 1.0, 1.1, -0.1]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    assert [r[0] for r in df.select(m.score_bin(F.col("s"))).collect()] == [
        0, 2, 3, 5, 1, 9, None, None,
    ]


def test_small_periods_and_one_class_periods_are_left_out(spark):
    nine = [("m", MARCH, 0.1 * i, i % 2) for i in range(9)]
    ten = [("m", APRIL, 0.1 * i, i % 2) for i in range(10)]
    same = [("m", dt.date(2024, 5, 1), 0.9, 1)] * 12
    one_label = [("m", dt.date(2024, 6, 1), 0.1 * i, 1) for i in range(10)]
    metrics = m.performance_over_time(m.period_profile(frame(spark, nine + ten + same + one_label)))
    found = {str(r.snapshot_date): r for r in metrics.collect()}
    assert set(found) == {"2024-04-01", "2024-06-01"}
    assert found["2024-06-01"].auc is None
    april = found["2024-04-01"]
    assert (april.true_positives, april.false_positives) == (3, 2)
    assert april.precision == pytest.approx(0.6) and april.recall == pytest.approx(0.6)


def test_no_positive_decision_gives_zero_rates(spark):
    rows = [("m", MARCH, 0.1, i % 2) for i in range(10)]
    (row,) = m.performance_over_time(m.period_profile(frame(spark, rows))).collect()
    assert (row.precision, row.recall, row.f1_score) == (0.0, 0.0, 0.0)
    assert row.auc == 0.5


def test_single_snapshot_is_stable(spark):
    scores = frame(spark, [("m", MARCH, 0.1 * i, i % 2) for i in range(10)])
    measures = m.stability_measures(m.period_profile(scores))
    (model,) = m.model_stability(measures).collect()
    assert (model.performance_volatility, model.consistency_score, model.is_stable) == (0, 1, True)
    (shift,) = m.score_shift(scores).collect()
    assert (shift.ks_statistic, shift.ks_p_value) == (0.0, 1.0)
    assert m.population_stability(m.period_profile(scores)).count() == 0
    assert m.prediction_patterns(measures).first().avg_prediction_psi == 0.0


def test_psi_skips_bins_empty_on_one_side(spark):
    rows = [("m", MARCH, s, 0) for s in (0.05, 0.05, 0.15, 0.15)]
    rows += [("m", APRIL, s, 0) for s in (0.05, 0.95, 0.95, 0.95)]
    (row,) = m.population_stability(m.period_profile(frame(spark, rows))).collect()
    import math

    assert row.psi == pytest.approx((0.25 - 0.5) * math.log(0.25 / 0.5))


def test_labels_are_matched_by_customer_or_by_date(spark):
    labels = spark.createDataFrame(
        [("l2", "c", 1, MARCH), ("l1", "c", 0, MARCH), ("l3", "c", 1, APRIL)],
        "loan_id string, Customer_ID string, label int, snapshot_date date",
    )
    scores = spark.createDataFrame(
        [("c", "2024-04-01", "m", 0.7, 1)],
        "Customer_ID string, snapshot_date string, model_version string, "
        "model_prediction_proba double, model_prediction_binary int",
    )
    assert m.monitored_scores(scores, labels).first().actual_label == 0
    assert m.monitored_scores(scores, labels, match_on_date=True).first().actual_label == 1
    assert m.monitored_scores(scores, labels, start="2024-05-01").count() == 0


def test_alert_levels_and_order(spark):
    metrics = spark.createDataFrame(
        [("m", MARCH, 0.76, 100), ("m", APRIL, 0.70, 40)],
        "model_version string, snapshot_date date, auc double, sample_count long",
    )
    stability = spark.createDataFrame(
        [("m", 0.2, 2 / 3, "MODERATE")],
        "model_version string, ks_statistic double, stability_score double, assessment string",
    )
    baseline = spark.createDataFrame([("m", 0.8)], "model_version string, auc_oot double")
    rows = m.performance_alerts(metrics, stability, baseline).collect()
    assert [(r.severity, r.type) for r in rows][:2] == [
        ("critical", "performance_degradation"),
        ("warning", "performance_degradation"),
    ]
    assert {r.type for r in rows} == {"performance_degradation", "stability", "distribution_drift"}
    assert rows[0].message == "Critical AUC degradation: 12.5% drop from baseline"


def test_low_volume_alert(spark):
    metrics = spark.createDataFrame(
        [("m", MARCH, 0.8, 100), ("m", APRIL, 0.8, 30)],
        "model_version string, snapshot_date date, auc double, sample_count long",
    )
    stability = spark.createDataFrame(
        [("m", 0.0, 1.0, "STABLE")],
        "model_version string, ks_statistic double, stability_score double, assessment string",
    )
    baseline = spark.createDataFrame([("m", 0.8)], "model_version string, auc_oot double")
    (row,) = m.performance_alerts(metrics, stability, baseline).collect()
    assert row.message == "Low prediction volume: 30 vs avg 65"
    assert (row.value, row.baseline, row.degradation_pct) == (30.0, 65.0, None)


def _sections(spark, *statuses):
    rows = [
        (MARCH, name, status, "", ["win " + name], ["issue " + name, "more " + name])
        for name, status in zip(h.SECTIONS, statuses)
    ]
    schema = (
        "run_date date, section string, status string, summary string, "
        "insights array<string>, concerns array<string>"
    )
    return spark.createDataFrame(rows, schema)


def test_health_bands(spark):
    good = h.executive_summary(_sections(spark, "success", "skipped", "excellent", "odd")).first()
    assert good.health_score == pytest.approx((1 + 0.7 + 1 + 0.3) / 4)
    assert (good.pipeline_status, good.business_impact) == ("good", "neutral")
    assert good.key_achievements == ["win data_validation", "win model_inference"]
    bad = h.executive_summary(_sections(spark, "failed", "failed", "failed", "critical_issues")).first()
    assert bad.pipeline_status == "critical"
    assert len(bad.priority_issues) == 5 and bad.priority_issues[0] == "issue data_validation"


def test_recommendations_and_severity(spark):
    sections = _sections(spark, "failed", "failed", "failed", "critical_issues")
    report = h.run_report(sections).first()
    assert report.priority_level == "high"
    assert report.immediate_actions[0] == h.FIRST_ACTION
    assert report.severity == "failure"


def test_missing_component_reads_no_data(spark):
    section = _sections(spark, "success").limit(0)
    runs = spark.createDataFrame([(MARCH,)], "run_date date")
    (row,) = h.with_missing_runs(section, runs, "model_training").collect()
    assert (row.status, row.concerns) == ("no_data", ["Training task did not execute"])
