"""Monitoring queries over the sample predictions."""

from pyspark.sql import functions as F

from ..operators import ledger
from ..operators import monitoring as m
from ..operators.registry import baseline_from_scores, with_span
from ..operators.scoring import shaped_predictions
from ..session import checkpointed
from ..sources.sample_tables import MODEL_VERSIONS
from .check import Registry

registry = Registry()

_PERIOD = "model_version snapshot_date "
START, END = "1999-01-01", "2000-12-31"


def labels(t):
    return ledger.label_store(ledger.silver_ledger(t.loans))


def scores(t):
    return m.monitored_scores(t.predictions, labels(t))


def profile(t):
    return m.period_profile(scores(t))


def measures(t):
    return m.stability_measures(profile(t))


def stability(t, period_profile):
    return m.overall_stability(m.stability_measures(period_profile), m.score_shift(scores(t)))


def baseline(t):
    """Training metrics of the sample models: AUC on three spans of their scored loans."""
    return baseline_from_scores(
        scores(t),
        {
            "train": ("1995-01-01", "1997-12-31"),
            "test": ("1998-01-01", "1998-06-30"),
            "oot": ("1998-07-01", "1998-12-31"),
        },
        feature_count=20,
    )


@registry.add(
    "monitored_scores",
    out="loan_id Customer_ID snapshot_date model_version model_prediction_proba:f actual_label:i",
    views="monitored",
    sql=f"SELECT * FROM monitored WHERE snapshot_date BETWEEN DATE '{START}' AND DATE '{END}'",
)
def monitored_scores(t):
    rows = m.monitored_scores(t.predictions, labels(t), START, END)
    return rows.select("loan_id", "Customer_ID", "snapshot_date", "model_version",
                       "model_prediction_proba", "actual_label")


@registry.add(
    "monitored_scores_by_date",
    out="model_version rows:i label_rate:f",
    views="predictions label_store",
    sql="""SELECT model_version, count(*) AS rows, avg(label::DOUBLE) AS label_rate FROM predictions p
      JOIN (SELECT * FROM label_store QUALIFY row_number() OVER (PARTITION BY Customer_ID, snapshot_date ORDER BY loan_id) = 1) l
      ON l.Customer_ID = p.Customer_ID AND l.snapshot_date = CAST(p.snapshot_date AS DATE) GROUP BY 1""",
)
def matched_on_date(t):
    rows = m.monitored_scores(t.predictions, labels(t), match_on_date=True)
    return rows.groupBy("model_version").agg(
        F.count("*").alias("rows"), F.avg("actual_label").alias("label_rate")
    )


@registry.add(
    "first_label_per_customer",
    out="Customer_ID actual_label:i",
    views="first_labels",
    sql="SELECT * FROM first_labels",
)
def first_labels(t):
    return m.first_label_per_customer(labels(t))


@registry.add(
    "score_decisions",
    out="model_version snapshot_date model_prediction_binary:i rows:i",
    views="predictions",
    sql="""SELECT model_version, CAST(snapshot_date AS DATE) AS snapshot_date, CASE WHEN model_prediction_proba >= 0.5 THEN 1 ELSE 0 END
      AS model_prediction_binary, count(*) AS rows FROM predictions GROUP BY 1, 2, 3""",
)
def decisions(t):
    scored = t.predictions.select(
        "Customer_ID", "feature_snapshot_date", F.col("model_prediction_proba").alias("probability_of_default"),
        F.col("model_version").alias("version"),
    )
    shaped = shaped_predictions(scored, "probability_of_default", F.col("version"))
    return shaped.groupBy(
        "model_version", F.col("snapshot_date").cast("date").alias("snapshot_date"), "model_prediction_binary"
    ).agg(F.count("*").alias("rows"))


def _auc(keys, source="monitored", score="model_prediction_proba"):
    """Rank-sum form of the AUC with mid-ranks for ties."""
    return f"""SELECT {keys}, CASE WHEN p > 0 AND n > 0 THEN (s - p * (p + 1) / 2.0::DOUBLE) / (p * n) END AS auc FROM (
      SELECT {keys}, count(*) FILTER (actual_label = 1)::DOUBLE AS p, count(*) FILTER (actual_label = 0)::DOUBLE AS n,
        coalesce(sum(mid) FILTER (actual_label = 1), 0) AS s
      FROM (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY {score})
          + (count(*) OVER (PARTITION BY {keys}, {score}) - 1) / 2.0::DOUBLE AS mid FROM {source}) GROUP BY {keys})"""


METRICS_SQL = f"""metrics AS (SELECT c.*, auc, 2 * auc - 1 AS gini,
    CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS "precision",
    CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall,
    CASE WHEN tp > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END AS f1_score
  FROM (SELECT model_version, snapshot_date, count(*) AS sample_count, avg(actual_label::DOUBLE) AS actual_default_rate,
      avg(model_prediction_binary::DOUBLE) AS predicted_default_rate, avg(model_prediction_proba) AS mean_prediction,
      stddev_samp(model_prediction_proba) AS std_prediction,
      count(*) FILTER (actual_label = 1 AND model_prediction_binary = 1) AS tp,
      count(*) FILTER (actual_label = 0 AND model_prediction_binary = 1) AS fp,
      count(*) FILTER (actual_label = 0 AND model_prediction_binary = 0) AS tn,
      count(*) FILTER (actual_label = 1 AND model_prediction_binary = 0) AS fn
    FROM monitored GROUP BY 1, 2) c
  JOIN ({_auc("model_version, snapshot_date")}) USING (model_version, snapshot_date)
  WHERE sample_count >= 10 AND sample_count <> tp AND sample_count <> tn)"""

_METRICS_OUT = _PERIOD + """sample_count:i actual_default_rate:f predicted_default_rate:f auc:f gini:f "precision":f recall:f
  f1_score:f mean_prediction:f std_prediction:f true_positives:i false_positives:i true_negatives:i false_negatives:i"""


@registry.add(
    "performance_over_time",
    out=_METRICS_OUT,
    views="monitored",
    sql=f"""WITH {METRICS_SQL} SELECT *, tp AS true_positives, fp AS false_positives, tn AS true_negatives,
      fn AS false_negatives FROM metrics""",
)
def performance(t):
    return m.performance_over_time(profile(t))


@registry.add(
    "roc_auc_by_period",
    out=_PERIOD + "auc:f gini:f",
    views="monitored",
    sql=f"SELECT *, 2 * auc - 1 AS gini FROM ({_auc('model_version, snapshot_date')})",
)
def auc_by_period(t):
    return m.auc_by_split(scores(t), m.PERIOD, m.SCORE, m.LABEL)


@registry.add(
    "score_statistics",
    out=_PERIOD + "mean:f std:f min:f max:f q25:f q75:f",
    views="monitored",
    sql="""SELECT model_version, snapshot_date, avg(model_prediction_proba) AS mean, stddev_samp(model_prediction_proba) AS std,
      min(model_prediction_proba) AS min, max(model_prediction_proba) AS max,
      quantile_cont(model_prediction_proba, 0.25) AS q25, quantile_cont(model_prediction_proba, 0.75) AS q75
      FROM monitored GROUP BY 1, 2""",
)
def score_statistics(t):
    return m.score_statistics(profile(t))


_ENDS = """ends AS (SELECT model_version, min(snapshot_date) AS first_date, max(snapshot_date) AS last_date,
    count(DISTINCT snapshot_date) AS periods FROM monitored GROUP BY 1)"""
_KS = f"""{_ENDS}, sides AS (SELECT model_version, snapshot_date = last_date AS is_last, model_prediction_proba AS s
    FROM monitored JOIN ends USING (model_version) WHERE snapshot_date IN (first_date, last_date)),
  steps AS (SELECT model_version, s,
      sum(count(*) FILTER (NOT is_last)) OVER (PARTITION BY model_version ORDER BY s)::DOUBLE
        / sum(count(*) FILTER (NOT is_last)) OVER (PARTITION BY model_version) AS f1,
      sum(count(*) FILTER (is_last)) OVER (PARTITION BY model_version ORDER BY s)::DOUBLE
        / sum(count(*) FILTER (is_last)) OVER (PARTITION BY model_version) AS f2
    FROM sides GROUP BY model_version, s),
  ks AS (SELECT model_version, max(abs(f1 - f2)) AS ks_statistic FROM steps GROUP BY 1)"""


@registry.add(
    "score_shift",
    out="model_version periods:i first_date last_date ks_statistic:f",
    views="monitored",
    sql=f"WITH {_KS} SELECT * FROM ends JOIN ks USING (model_version)",
)
def score_shift(t):
    return m.score_shift(scores(t)).drop("ks_p_value")


_DRIFT = """drift AS (SELECT model_version, stddev_samp(mean) AS mean_drift, stddev_samp(std) AS std_drift FROM (
    SELECT model_version, snapshot_date, avg(model_prediction_proba) AS mean, stddev_samp(model_prediction_proba) AS std
    FROM monitored GROUP BY 1, 2) GROUP BY 1)"""


@registry.add(
    "prediction_stability",
    out="model_version mean_drift:f std_drift:f ks_statistic:f is_stable",
    views="monitored",
    sql=f"""WITH {_KS}, {_DRIFT} SELECT *, mean_drift < 0.05::DOUBLE AND ks_statistic < 0.1::DOUBLE AS is_stable
      FROM drift JOIN ks USING (model_version)""",
)
def prediction_stability(t):
    return m.prediction_stability(measures(t), m.score_shift(scores(t))).drop("ks_p_value")


@registry.add(
    "score_shift_p_value",
    out="model_version ks_p_value:f",
    views="monitored",
    sql=f"""WITH {_KS}, x AS (SELECT model_version, ks_statistic * ks_statistic * n1 * n2 / (n1 + n2) AS x2 FROM ks JOIN (
        SELECT model_version, count(*) FILTER (NOT is_last)::DOUBLE AS n1, count(*) FILTER (is_last)::DOUBLE AS n2
        FROM sides GROUP BY 1) USING (model_version))
      SELECT model_version, CASE WHEN any_value(x2) < 0.04::DOUBLE THEN 1 ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
        2 * sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0::DOUBLE * k * k * x2)))) END AS ks_p_value
      FROM x, (SELECT unnest(range(1, 101)) AS k) GROUP BY model_version""",
)
def p_value(t):
    return m.score_shift(scores(t)).select("model_version", "ks_p_value")


_AUC_SPREAD = f"""volatility AS (SELECT model_version, count(*) AS periods, stddev_samp(auc) AS v, avg(auc) AS mean FROM (
    SELECT model_version, auc FROM ({_auc("model_version, snapshot_date")}) JOIN (
      SELECT model_version, snapshot_date FROM monitored GROUP BY 1, 2 HAVING count(*) >= 10)
    USING (model_version, snapshot_date)) GROUP BY 1)"""


@registry.add(
    "model_stability",
    out="model_version periods:i performance_volatility:f consistency_score:f is_stable",
    views="monitored",
    sql=f"""WITH {_AUC_SPREAD} SELECT model_version, periods, CASE WHEN periods < 2 THEN 0 ELSE v END AS performance_volatility,
      CASE WHEN periods < 2 THEN 1 WHEN mean > 0 THEN 1 - v / mean ELSE 0 END AS consistency_score,
      periods < 2 OR v < 0.05::DOUBLE AS is_stable FROM volatility""",
)
def model_stability(t):
    return m.model_stability(measures(t))


_SHARES = f"""bins AS (SELECT model_version, snapshot_date, CASE {
    " ".join(f"WHEN model_prediction_proba >= {i} * 0.1::DOUBLE THEN {i}" for i in range(9, -1, -1))
} END AS bin FROM monitored WHERE model_prediction_proba BETWEEN 0 AND 1),
  shares AS (SELECT model_version, snapshot_date, bin, count(*) AS count,
      count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY model_version, snapshot_date) AS share FROM bins GROUP BY 1, 2, 3)"""


@registry.add(
    "score_histogram",
    out=_PERIOD + "bin:i count:i share:f",
    views="monitored",
    sql=f"WITH {_SHARES} SELECT * FROM shares",
)
def score_histogram(t):
    return m.score_histogram(profile(t))


_PSI = f"""{_SHARES}, {_ENDS}, psi AS (SELECT model_version, snapshot_date, coalesce(psi, 0) AS psi FROM (
      SELECT DISTINCT model_version, snapshot_date FROM monitored JOIN ends USING (model_version) WHERE snapshot_date > first_date)
    LEFT JOIN (SELECT s.model_version, s.snapshot_date, sum((s.share - b.share) * ln(s.share / b.share)) AS psi FROM shares s
      JOIN ends e ON e.model_version = s.model_version
      JOIN shares b ON b.model_version = s.model_version AND b.bin = s.bin AND b.snapshot_date = e.first_date GROUP BY 1, 2)
    USING (model_version, snapshot_date)),
  patterns AS (SELECT model_version, periods AS num_periods, coalesce(p, 0) AS avg_prediction_psi, coalesce(p, 0) > 0.2::DOUBLE
      AS has_significant_drift FROM ends LEFT JOIN (SELECT model_version, avg(psi) AS p FROM psi GROUP BY 1) USING (model_version))"""


@registry.add(
    "population_stability_index",
    out=_PERIOD + "psi:f",
    views="monitored",
    sql=f"WITH {_PSI} SELECT * FROM psi",
)
def psi(t):
    return m.population_stability(profile(t))


@registry.add(
    "prediction_patterns",
    out="model_version num_periods:i avg_prediction_psi:f has_significant_drift",
    views="monitored",
    sql=f"WITH {_PSI} SELECT * FROM patterns",
)
def patterns(t):
    return m.prediction_patterns(measures(t))


_OVERALL = f"""{_KS}, {_DRIFT}, {_AUC_SPREAD}, {_PSI.replace(_ENDS + ", ", "")}, overall AS (SELECT *,
    CASE WHEN stability_score >= 0.8::DOUBLE THEN 'STABLE' WHEN stability_score >= 0.6::DOUBLE THEN 'MODERATE' ELSE 'UNSTABLE' END AS assessment,
    1 - least(avg_prediction_psi, 1.0::DOUBLE) AS prediction_stability_score
  FROM (SELECT *, (prediction_stable::INT + performance_stable::INT + distribution_stable::INT) / 3.0::DOUBLE AS stability_score
    FROM (SELECT model_version, ks_statistic, mean_drift < 0.05::DOUBLE AND ks_statistic < 0.1::DOUBLE AS prediction_stable,
        periods < 2 OR v < 0.05::DOUBLE AS performance_stable, avg_prediction_psi, avg_prediction_psi < 0.2::DOUBLE AS distribution_stable
      FROM drift JOIN ks USING (model_version) JOIN volatility USING (model_version) JOIN patterns USING (model_version))))"""


@registry.add(
    "overall_stability",
    out="""model_version ks_statistic:f prediction_stable performance_stable avg_prediction_psi:f distribution_stable
      stability_score:f assessment prediction_stability_score:f""",
    views="monitored",
    sql=f"WITH {_OVERALL} SELECT * FROM overall",
)
def overall(t):
    return stability(t, profile(t))


@registry.add(
    "drift_classes",
    out='model_version measure "value":f drift',
    views="monitored",
    sql=f"""WITH {_OVERALL} SELECT *, CASE WHEN value > 0.2::DOUBLE THEN 'high' WHEN value > 0.1::DOUBLE THEN 'moderate' ELSE 'low' END AS drift
      FROM (SELECT model_version, 'overall_prediction_drift' AS measure, avg_prediction_psi AS value FROM overall UNION ALL
        SELECT model_version, 'prediction_stability_score', prediction_stability_score FROM overall)""",
)
def drift_classes(t):
    return m.drift_classes(stability(t, profile(t)))


_SPANS = {"train": ("1995-01-01", "1997-12-31"), "test": ("1998-01-01", "1998-06-30"), "oot": ("1998-07-01", "1998-12-31")}
_SPLIT_SCORES = """spans AS (SELECT *, CASE """ + " ".join(
    f"WHEN snapshot_date BETWEEN DATE '{a}' AND DATE '{b}' THEN '{s}'" for s, (a, b) in _SPANS.items()
) + """ END AS split FROM monitored), split_auc AS (""" + _auc(
    "model_version, split", "(SELECT * FROM spans WHERE split IS NOT NULL)"
) + """), baseline AS (SELECT model_version, max(auc) FILTER (split = 'train') AS auc_train, max(auc) FILTER (split = 'test') AS auc_test,
    max(auc) FILTER (split = 'oot') AS auc_oot FROM split_auc GROUP BY 1)"""  # fmt: skip


@registry.add(
    "auc_by_split",
    out="model_version split auc:f gini:f",
    views="monitored",
    sql=f"WITH {_SPLIT_SCORES} SELECT *, 2 * auc - 1 AS gini FROM split_auc",
)
def split_auc(t):
    spanned = with_span(scores(t), _SPANS).where("split IS NOT NULL")
    return m.auc_by_split(spanned, ["model_version", "split"], m.SCORE, m.LABEL)


@registry.add(
    "training_baseline",
    out="model_version auc_train:f auc_test:f auc_oot:f gini_train:f gini_test:f gini_oot:f training_date feature_count:i",
    views="monitored",
    sql=f"""WITH {_SPLIT_SCORES} SELECT *, 2 * auc_train - 1 AS gini_train, 2 * auc_test - 1 AS gini_test, 2 * auc_oot - 1 AS gini_oot,
      DATE '1999-01-01' AS training_date, 20 AS feature_count FROM baseline WHERE model_version = '{MODEL_VERSIONS[1]}'""",
)
def training_baseline(t):
    return m.baseline_metrics(baseline(t), MODEL_VERSIONS[1])


_ALERTS = f"""{METRICS_SQL}, {_OVERALL}, {_SPLIT_SCORES}, volume AS (SELECT model_version, max(snapshot_date) AS last_date,
    arg_max(sample_count, snapshot_date) AS recent, avg(sample_count) AS usual FROM metrics GROUP BY 1),
  alerts AS (
    SELECT model_version, 'performance_degradation' AS type, CASE WHEN loss >= 0.1::DOUBLE THEN 'critical' ELSE 'warning' END AS severity,
      'auc' AS metric, snapshot_date AS date, auc AS "value", auc_oot AS baseline, loss * 100 AS degradation_pct,
      CASE WHEN loss >= 0.1::DOUBLE THEN 'Critical AUC degradation: ' ELSE 'AUC degradation warning: ' END
        || printf('%.1f', loss * 100) || '% drop from baseline' AS message
    FROM (SELECT *, (auc_oot - auc) / auc_oot AS loss FROM metrics JOIN baseline USING (model_version)) WHERE loss >= 0.05::DOUBLE
    UNION ALL SELECT model_version, 'stability', CASE WHEN assessment = 'UNSTABLE' THEN 'critical' ELSE 'warning' END, 'stability_score',
      last_date, stability_score, NULL, NULL, 'Model stability is ' || lower(assessment) || ' (score: ' || printf('%.2f', stability_score) || ')'
    FROM overall JOIN volume USING (model_version) WHERE assessment <> 'STABLE'
    UNION ALL SELECT model_version, 'distribution_drift', 'warning', 'ks_statistic', last_date, ks_statistic, NULL, NULL,
      'Prediction distribution drift detected (KS: ' || printf('%.3f', ks_statistic) || ')'
    FROM overall JOIN volume USING (model_version) WHERE ks_statistic >= 0.15::DOUBLE
    UNION ALL SELECT model_version, 'sample_volume', 'warning', 'sample_count', last_date, recent, usual, NULL,
      'Low prediction volume: ' || recent || ' vs avg ' || printf('%.0f', usual) FROM volume WHERE recent < usual * 0.5::DOUBLE)"""


def alerts(t):
    kept = checkpointed(profile(t))
    return m.performance_alerts(m.performance_over_time(kept), stability(t, kept), baseline(t))


@registry.add(
    "performance_alerts",
    out='model_version type severity metric "date" "value":f baseline:f degradation_pct:f message',
    views="monitored",
    sql=f"WITH {_ALERTS} SELECT * FROM alerts",
)
def performance_alerts(t):
    return alerts(t)


@registry.add(
    "most_severe_alerts",
    out='model_version severity metric "date" "value":f',
    views="monitored",
    sql=f"""WITH {_ALERTS} SELECT * FROM alerts
      ORDER BY CASE severity WHEN 'critical' THEN 0 ELSE 1 END, "date", model_version, type LIMIT 3""",
)
def most_severe(t):
    ordered = alerts(t).orderBy(
        F.when(F.col("severity") == "critical", 0).otherwise(1), "date", "model_version", "type"
    )
    return ordered.limit(3).select("model_version", "severity", "metric", "date", "value")


@registry.add(
    "monitoring_summary",
    out="""model_version periods_analyzed:i avg_auc:f min_auc:f max_auc:f auc_volatility:f stability_score:f assessment
      total_alerts:i critical_alerts:i warning_alerts:i recommendation""",
    views="monitored",
    sql=f"""WITH {_ALERTS} SELECT m.*, stability_score, assessment, coalesce(total, 0) AS total_alerts, coalesce(critical, 0) AS critical_alerts,
      coalesce(warning, 0) AS warning_alerts, concat_ws('; ',
        CASE WHEN critical > 0 THEN 'Critical performance degradation detected: act now' END,
        CASE WHEN assessment = 'UNSTABLE' THEN 'Consider retraining the unstable model' END,
        CASE WHEN assessment = 'STABLE' AND coalesce(critical, 0) = 0 THEN 'Performance is stable: continue monitoring' END) AS recommendation
      FROM (SELECT model_version, count(*) AS periods_analyzed, avg(auc) AS avg_auc, min(auc) AS min_auc, max(auc) AS max_auc,
        stddev_samp(auc) AS auc_volatility FROM metrics GROUP BY 1) m
      LEFT JOIN overall USING (model_version) LEFT JOIN (SELECT model_version, count(*) AS total,
        count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning FROM alerts GROUP BY 1)
      USING (model_version)""",
)
def summary(t):
    kept = checkpointed(profile(t))
    metrics, verdict = m.performance_over_time(kept), stability(t, kept)
    return m.monitoring_summary(metrics, verdict, m.performance_alerts(metrics, verdict, baseline(t)))


@registry.add(
    "trend_chart",
    out=_PERIOD + "auc:f gini:f sample_count:i actual_default_rate:f predicted_default_rate:f mean:f std:f q25:f q75:f",
    views="monitored",
    sql=f"""WITH {METRICS_SQL} SELECT metrics.*, s.mean, s.std, s.q25, s.q75 FROM metrics JOIN (
      SELECT model_version, snapshot_date, avg(model_prediction_proba) AS mean, stddev_samp(model_prediction_proba) AS std,
        quantile_cont(model_prediction_proba, 0.25) AS q25, quantile_cont(model_prediction_proba, 0.75) AS q75
      FROM monitored GROUP BY 1, 2) s USING (model_version, snapshot_date)""",
)
def trend(t):
    kept = checkpointed(profile(t))
    return m.trend_chart(m.performance_over_time(kept), m.score_statistics(kept))
