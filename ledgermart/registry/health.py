"""Run-health queries: component results per month are derived from the sample stores."""

from pyspark.sql import functions as F

from ..operators import health as h
from ..operators.monitoring import performance_over_time
from ..session import checkpointed
from .check import Registry
from .features import full_store
from .monitoring import METRICS_SQL, labels, profile

registry = Registry()

_OUT = "run_date section status summary insights concerns"


def _lists(df, *columns):
    """Lists as text, so that both engines print them alike."""
    return df.withColumns({c: F.array_join(c, " | ") for c in columns})


def runs(t):
    """Every month in which a loan record was taken."""
    return t.loans.select(F.col("snapshot_date").alias("run_date")).distinct()


def validation_results(t):
    """Completeness of the feature store and default rate of the label store per month."""
    complete = full_store(t).groupBy(F.col("feature_snapshot_date").alias("run_date")).agg(
        F.avg("data_completeness_score").alias("feature_completeness")
    )
    rate = labels(t).groupBy(F.col("snapshot_date").alias("run_date")).agg(
        F.avg("label").alias("default_rate")
    )
    passed = F.col("feature_completeness") >= 0.8
    return complete.join(rate, "run_date").select(
        "run_date",
        "feature_completeness",
        "default_rate",
        F.col("feature_completeness").alias("overall_score"),
        passed.alias("validation_passed"),
        F.when(passed, "success").otherwise("failed").alias("overall_status"),
    )


def training_results(t):
    """Every third month trains; it succeeds with at least 90 labels in the month."""
    counts = labels(t).groupBy(F.col("snapshot_date").alias("run_date")).agg(F.count("*").alias("n"))
    enough = F.col("n") >= 90
    models = F.array(F.lit("logistic_regression"), F.lit("random_forest"), F.lit("xgboost"))
    return counts.select(
        "run_date",
        (F.month("run_date") % 3 == 1).alias("training_executed"),
        enough.alias("success"),
        models.alias("models_trained"),
        F.when(~enough, F.format_string("only %d labels", "n")).alias("error"),
    )


def inference_results(t):
    """A model's scoring of a month succeeds when at least 45 % of its scores are decided positive."""
    per_model = t.predictions.groupBy(
        F.col("snapshot_date").cast("date").alias("run_date"), "model_version"
    ).agg(F.avg("model_prediction_binary").alias("share"))
    good = F.col("share") >= 0.45
    named = F.col("model_version")
    return per_model.groupBy("run_date").agg(
        F.array_sort(F.collect_list(F.when(good, named))).alias("successful_models"),
        F.array_sort(F.collect_list(F.when(~good, named))).alias("failed_models"),
        F.avg(good.cast("int")).alias("success_rate"),
    )


def monitoring_results(t):
    """Low AUC of a month is a warning, very low AUC critical; December is not monitored."""
    metrics = performance_over_time(profile(t)).where("auc IS NOT NULL")
    named, auc = F.col("model_version"), F.col("auc")
    return metrics.groupBy(F.col("snapshot_date").alias("run_date")).agg(
        F.max(F.month("snapshot_date") != 12).alias("monitoring_executed"),
        F.array_sort(F.collect_list(named)).alias("models_monitored"),
        F.array_sort(F.collect_list(F.when(auc < 0.42, named))).alias("critical_alerts"),
        F.array_sort(F.collect_list(F.when(auc < 0.46, named))).alias("warning_alerts"),
    )


_VALIDATION = """SELECT run_date, 'data_validation' AS section, CASE WHEN c >= 0.8::DOUBLE THEN 'success' ELSE 'failed' END AS status,
  'Data validation ' || CASE WHEN c >= 0.8::DOUBLE THEN 'passed' ELSE 'failed' END || ' with score ' || printf('%.2f', c) AS summary,
  list_filter([CASE WHEN c >= 0.8::DOUBLE THEN 'Feature store quality is acceptable' END, CASE WHEN r BETWEEN 0.01 AND 0.15 THEN
    'Label distribution is balanced (default rate: ' || printf('%.3f', r) || ')' END], lambda x: x IS NOT NULL) AS insights,
  list_filter([CASE WHEN c < 0.8::DOUBLE THEN 'Feature completeness low: ' || printf('%.2f', c) END, CASE WHEN NOT r BETWEEN 0.01 AND 0.15 THEN
    'Unusual default rate detected: ' || printf('%.3f', r) END], lambda x: x IS NOT NULL) AS concerns
  FROM (SELECT feature_snapshot_date AS run_date, avg(data_completeness_score) AS c FROM feature_store GROUP BY 1)
  JOIN (SELECT snapshot_date AS run_date, avg(label::DOUBLE) AS r FROM label_store GROUP BY 1) USING (run_date)"""
_TRAINING = """SELECT run_date, 'model_training' AS section, CASE WHEN NOT e THEN 'skipped' WHEN n >= 90 THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN NOT e THEN 'Training was skipped - using existing models' WHEN n >= 90 THEN 'Successfully trained 3 models'
    ELSE 'Training failed: only ' || n || ' labels' END AS summary,
  CASE WHEN NOT e THEN ['Training skipped according to schedule'] WHEN n >= 90
    THEN ['Models trained: logistic_regression, random_forest, xgboost'] ELSE [] END AS insights,
  CASE WHEN e AND n < 90 THEN ['Training error: only ' || n || ' labels'] ELSE [] END AS concerns
  FROM (SELECT snapshot_date AS run_date, month(snapshot_date) % 3 = 1 AS e, count(*) AS n FROM label_store GROUP BY 1, 2)"""
_INFERENCE = """SELECT run_date, 'model_inference' AS section, CASE WHEN g >= 0.8 * n THEN 'excellent' WHEN g >= 0.5 * n THEN 'partial_success' ELSE 'failed' END AS status,
  'Inference ' || CASE WHEN g >= 0.8 * n THEN 'highly successful' WHEN g >= 0.5 * n THEN 'partially successful' ELSE 'largely failed' END
    || ': ' || g || '/' || n || ' models' AS summary,
  CASE WHEN g > 0 THEN ['Successfully processed models: ' || good] ELSE [] END AS insights,
  CASE WHEN g < n THEN ['Failed models: ' || bad] ELSE [] END AS concerns
  FROM (SELECT run_date, count(*) AS n, count(*) FILTER (s >= 0.45::DOUBLE) AS g,
      string_agg(model_version, ', ' ORDER BY model_version) FILTER (s >= 0.45::DOUBLE) AS good,
      string_agg(model_version, ', ' ORDER BY model_version) FILTER (s < 0.45::DOUBLE) AS bad
    FROM (SELECT CAST(snapshot_date AS DATE) AS run_date, model_version, avg(model_prediction_binary::DOUBLE) AS s FROM predictions GROUP BY 1, 2) GROUP BY 1)"""
_MONITORING = """SELECT run_date, 'model_monitoring' AS section, CASE WHEN month(run_date) = 12 THEN 'skipped' WHEN len(c) > 0 THEN 'critical_issues'
    WHEN len(w) > 0 THEN 'warnings' ELSE 'healthy' END AS status,
  CASE WHEN month(run_date) = 12 THEN 'Monitoring was skipped' WHEN len(c) > 0 THEN 'Critical issues detected in ' || len(c) || ' cases'
    WHEN len(w) > 0 THEN 'Warnings detected for ' || len(w) || ' models' ELSE 'All ' || n || ' models are performing well' END AS summary,
  CASE WHEN month(run_date) <> 12 AND len(c) = 0 AND len(w) = 0 THEN ['No performance or stability issues detected'] ELSE [] END AS insights,
  CASE WHEN month(run_date) = 12 THEN [] WHEN len(c) > 0 THEN list_transform(c, lambda x: 'Critical: ' || x)
    WHEN len(w) > 0 THEN list_transform(w, lambda x: 'Warning: ' || x) ELSE [] END AS concerns
  FROM (SELECT snapshot_date AS run_date, count(*) AS n, coalesce(list(model_version ORDER BY model_version) FILTER (auc < 0.42::DOUBLE), []) AS c,
      coalesce(list(model_version ORDER BY model_version) FILTER (auc < 0.46::DOUBLE), []) AS w FROM metrics WHERE auc IS NOT NULL GROUP BY 1)"""
_JOINED = "* REPLACE (array_to_string(insights, ' | ') AS insights, array_to_string(concerns, ' | ') AS concerns)"


@registry.add(
    "validation_section",
    out=_OUT,
    views="feature_store label_store",
    sql=f"SELECT {_JOINED} FROM ({_VALIDATION})",
)
def validation(t):
    return _lists(h.validation_section(validation_results(t)), "insights", "concerns")


@registry.add(
    "training_section", out=_OUT, views="label_store", sql=f"SELECT {_JOINED} FROM ({_TRAINING})"
)
def training(t):
    return _lists(h.training_section(training_results(t)), "insights", "concerns")


@registry.add(
    "inference_section", out=_OUT, views="predictions", sql=f"SELECT {_JOINED} FROM ({_INFERENCE})"
)
def inference(t):
    return _lists(h.inference_section(inference_results(t)), "insights", "concerns")


@registry.add(
    "monitoring_section",
    out=_OUT,
    views="monitored",
    sql=f"WITH {METRICS_SQL} SELECT {_JOINED} FROM ({_MONITORING})",
)
def monitoring(t):
    return _lists(h.monitoring_section(monitoring_results(t)), "insights", "concerns")


# fixed values, written out so that the SQL does not lean on the operators' constants
_SCORES_SQL = """WHEN 'excellent' THEN 1.0::DOUBLE WHEN 'success' THEN 1.0::DOUBLE WHEN 'healthy' THEN 1.0::DOUBLE
        WHEN 'good' THEN 0.8::DOUBLE WHEN 'partial_success' THEN 0.6::DOUBLE WHEN 'warnings' THEN 0.6::DOUBLE
        WHEN 'warning' THEN 0.4::DOUBLE WHEN 'failed' THEN 0.2::DOUBLE WHEN 'critical_issues' THEN 0.2::DOUBLE
        WHEN 'critical' THEN 0.0::DOUBLE WHEN 'no_data' THEN 0.0::DOUBLE WHEN 'analysis_error' THEN 0.0::DOUBLE
        WHEN 'skipped' THEN 0.7::DOUBLE"""
_ABSENT_SQL = {
    "data_validation": ("No data validation results available", "Data validation task did not execute"),
    "model_training": ("No training results available", "Training task did not execute"),
    "model_inference": ("No inference results available", "Inference task did not execute"),
    "model_monitoring": ("No monitoring results available", "Monitoring task did not execute"),
}
_ACTIONS_SQL = """CASE WHEN u THEN 'Investigate pipeline failures before next execution' END,
        CASE WHEN u AND len(list_filter(found, lambda x: contains(lower(x), 'data validation'))) > 0
          THEN 'Fix data quality issues in feature and label stores' END,
        CASE WHEN u AND len(list_filter(found, lambda x: contains(lower(x), 'training'))) > 0
          THEN 'Review training process and address model training failures' END,
        CASE WHEN u AND len(list_filter(found, lambda x: contains(lower(x), 'inference'))) > 0
          THEN 'Check model artifacts and inference pipeline integrity' END"""
_SHORT_TERM_SQL = """['Implement automated alerting for pipeline failures', 'Add more comprehensive monitoring metrics',
        'Review and optimize resource allocation']"""
_LONG_TERM_SQL = """['Consider implementing A/B testing for model deployments', 'Explore automated model retraining triggers',
        'Implement advanced feature engineering techniques', 'Consider model ensemble strategies for improved performance']"""


def _absent(name):
    summary, concern = _ABSENT_SQL[name]
    return f"""SELECT run_date, '{name}' AS section, 'no_data' AS status, '{summary}' AS summary, [] AS insights, ['{concern}'] AS concerns
      FROM runs WHERE run_date NOT IN (SELECT run_date FROM s WHERE section = '{name}')"""


_SECTIONS = f"""{METRICS_SQL}, runs AS (SELECT DISTINCT snapshot_date AS run_date FROM loans),
  s AS ({_VALIDATION} UNION ALL {_TRAINING} UNION ALL {_INFERENCE} UNION ALL {_MONITORING}),
  sections AS (SELECT *, CASE section WHEN 'data_validation' THEN 1 WHEN 'model_training' THEN 2 WHEN 'model_inference' THEN 3 ELSE 4 END AS place,
      CASE status {_SCORES_SQL} ELSE 0.3::DOUBLE END AS score
    FROM (SELECT * FROM s UNION ALL {" UNION ALL ".join(_absent(n) for n in _ABSENT_SQL)})),
  summary AS (SELECT *, CASE WHEN health_score >= 0.8 THEN 'excellent' WHEN health_score >= 0.6 THEN 'good' WHEN health_score >= 0.4 THEN 'concerning'
      ELSE 'critical' END AS pipeline_status, CASE WHEN health_score >= 0.8 THEN 'positive' WHEN health_score >= 0.6 THEN 'neutral'
      WHEN health_score >= 0.4 THEN 'at_risk' ELSE 'negative' END AS business_impact
    FROM (SELECT run_date, list_reduce(list(score ORDER BY place), lambda a, b: a + b) / count(*) AS health_score, count(*) AS components,
      flatten(list(CASE WHEN status IN ('excellent', 'success', 'healthy') THEN insights ELSE [] END ORDER BY place))[1:5] AS key_achievements,
      flatten(list(CASE WHEN status IN ('critical', 'failed', 'critical_issues') THEN concerns ELSE [] END ORDER BY place))[1:5] AS priority_issues,
      flatten(list(concerns ORDER BY place)) AS found,
      {", ".join(f"max(status) FILTER (section = '{n}') AS {n}_status" for n in _ABSENT_SQL)} FROM sections GROUP BY 1)),
  advice AS (SELECT run_date, CASE WHEN len(found) > 5 THEN 'high' WHEN len(found) > 2 THEN 'medium' WHEN u THEN 'high' ELSE 'low' END AS priority_level,
      list_filter([{_ACTIONS_SQL}],
        lambda x: x IS NOT NULL) AS immediate_actions,
      CASE WHEN pipeline_status IN ('good', 'concerning') THEN {_SHORT_TERM_SQL} ELSE [] END AS short_term_improvements, {_LONG_TERM_SQL} AS long_term_optimizations
    FROM (SELECT *, pipeline_status IN ('critical', 'concerning') AS u FROM summary)),
  announced AS (SELECT run_date, CASE WHEN pipeline_status = 'critical' THEN 'failure' WHEN pipeline_status = 'concerning' OR health_score < 0.5 THEN 'critical'
      WHEN pipeline_status = 'good' OR len(priority_issues) > 0 THEN 'warning' ELSE 'success' END AS severity FROM summary)"""


def sections(t):
    """Sections of all components; each component is computed once, by a plan of its own, as it is read twice."""
    taken = checkpointed(runs(t))
    parts = {
        "data_validation": h.validation_section(validation_results(t)),
        "model_training": h.training_section(training_results(t)),
        "model_inference": h.inference_section(inference_results(t)),
        "model_monitoring": h.monitoring_section(monitoring_results(t)),
    }
    return h.combine_sections(
        *[h.with_missing_runs(checkpointed(part), taken, name) for name, part in parts.items()]
    )


_ALL = "feature_store monitored"
_SUMMARY_OUT = "run_date health_score:f pipeline_status business_impact key_achievements priority_issues"


@registry.add(
    "executive_summary",
    out=_SUMMARY_OUT,
    views=_ALL,
    sql=f"""WITH {_SECTIONS} SELECT * REPLACE (array_to_string(key_achievements, ' | ') AS key_achievements,
      array_to_string(priority_issues, ' | ') AS priority_issues) FROM summary""",
)
def executive_summary(t):
    return _lists(h.executive_summary(sections(t)), "key_achievements", "priority_issues")


_ADVICE = ("immediate_actions", "short_term_improvements", "long_term_optimizations")
_ADVICE_JOINED = ", ".join(f"array_to_string({c}, ' | ') AS {c}" for c in _ADVICE)


@registry.add(
    "recommendations",
    out="run_date priority_level " + " ".join(_ADVICE),
    views=_ALL,
    sql=f"WITH {_SECTIONS} SELECT * REPLACE ({_ADVICE_JOINED}) FROM advice",
)
def recommendations(t):
    every = checkpointed(sections(t))
    return _lists(h.recommendations(every, h.executive_summary(every)), *_ADVICE)


@registry.add(
    "run_report",
    out=f"""run_date components:i {" ".join(f"{n}_status" for n in _ABSENT_SQL)} health_score:f pipeline_status business_impact
      priority_level severity""",
    views=_ALL,
    sql=f"WITH {_SECTIONS} SELECT * FROM summary JOIN advice USING (run_date) JOIN announced USING (run_date)",
)
def run_report(t):
    return h.run_report(checkpointed(sections(t))).drop("key_achievements", "priority_issues", *_ADVICE)


@registry.add(
    "run_severity",
    out="severity runs:i",
    views=_ALL,
    sql=f"WITH {_SECTIONS} SELECT severity, count(*) AS runs FROM announced GROUP BY 1",
)
def run_severity(t):
    summary = h.executive_summary(sections(t))
    level = h.severity(F.col("pipeline_status"), F.col("health_score"), F.col("priority_issues"))
    return summary.groupBy(level.alias("severity")).agg(F.count("*").alias("runs"))
