"""Queries on stores, calendars and date rules."""

from pyspark.sql import functions as F

from ..operators import calendar as c
from ..operators import ledger, silver
from ..operators.features import clickstream_aggregates, empty_features, lookback_slice
from ..operators.profile import score_summary
from ..operators.registry import with_version_parts
from ..plans import medallion
from ..plans.lake import Lake
from ..session import stage_folder
from ..sources import stores
from ..sources.sample_tables import MODEL_VERSIONS
from .check import Registry
from .features import DAY, full_store, silver_sources
from .monitoring import labels, scores

registry = Registry()

_ORDER_MONTHS = """months AS (SELECT CAST(m AS DATE) AS snapshot_date, row_number() OVER (ORDER BY m) - 1 AS months_since_start
  FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS m FROM orders))"""
FIRST_TRAINING = "1999-01-01"


def order_months(t):
    bounds = t.table("orders").agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return c.months_between_bounds(bounds, "start", "end")


@registry.add(
    "snapshot_slice",
    out="loan_id installment_num:i overdue_amt:f",
    views="loans",
    sql="SELECT loan_id, installment_num, overdue_amt FROM loans WHERE snapshot_date = DATE '1998-05-01'",
)
def one_snapshot(t):
    return stores.snapshot_slice(t.loans, "1998-05-01").select("loan_id", "installment_num", "overdue_amt")


@registry.add(
    "bronze_lineage",
    out="Customer_ID snapshot_date fe_1:f data_source processing_date",
    views="clickstream",
    sql="""SELECT Customer_ID, snapshot_date, fe_1, 'clickstream' AS data_source,
      strftime(snapshot_date, '%Y-%m-%d') AS processing_date FROM clickstream""",
)
def lineage(t):
    return stores.with_lineage(t.clickstream, "clickstream").select(
        "Customer_ID", "snapshot_date", "fe_1", "data_source", "processing_date"
    )


_HALF = "1998-01-01"


@registry.add(
    "rows_landed_in_three_runs",
    out="snapshot_date records:i loans:i",
    views="loans",
    sql="""SELECT snapshot_date, count(*) AS records, count(DISTINCT loan_id) AS loans FROM loans
      WHERE snapshot_date = date_trunc('month', snapshot_date) GROUP BY snapshot_date""",
)
def landed(t):
    lake = Lake(stage_folder(t.loans.sparkSession, "landing"))
    folder = f"{lake.root}/raw"
    late = F.coalesce(F.col("snapshot_date") >= F.lit(_HALF).cast("date"), F.lit(False))
    for rows in (t.loans.where(~late), t.loans.where(late), None):
        if rows is not None:
            rows.write.mode("append").csv(folder, header=True)
        medallion.land(t.loans.sparkSession, lake, medallion.LOANS, folder, t.loans.columns)
    return t.loans.sparkSession.read.parquet(lake.landed(medallion.LOANS)).groupBy("snapshot_date").agg(
        F.count("*").alias("records"), F.count_distinct("loan_id").alias("loans")
    )


@registry.add(
    "month_calendar",
    out="snapshot_date months_since_start:i",
    sql=f"WITH {_ORDER_MONTHS} SELECT * FROM months",
)
def months(t):
    return order_months(t)


@registry.add(
    "months_with_enough_history",
    out="snapshot_date months_since_start:i",
    sql=f"WITH {_ORDER_MONTHS} SELECT * FROM months WHERE months_since_start >= 6",
)
def gated(t):
    return c.with_enough_history(order_months(t), 6)


@registry.add(
    "timeline_points",
    out="analysis_date",
    sql=f"""WITH {_ORDER_MONTHS} SELECT snapshot_date AS analysis_date FROM months, (SELECT count(*) AS n FROM months)
      WHERE months_since_start IN (n // 4, n // 2, 3 * n // 4)""",
)
def points(t):
    return c.timeline_points(order_months(t))


@registry.add(
    "training_windows",
    out="snapshot_date train_test_start train_test_end oot_start oot_end",
    sql=f"""WITH {_ORDER_MONTHS} SELECT snapshot_date, CAST(snapshot_date - INTERVAL 14 MONTH AS DATE) AS train_test_start,
      CAST(snapshot_date - INTERVAL 2 MONTH - INTERVAL 1 DAY AS DATE) AS train_test_end,
      CAST(snapshot_date - INTERVAL 2 MONTH AS DATE) AS oot_start, CAST(snapshot_date - INTERVAL 1 DAY AS DATE) AS oot_end FROM months""",
)
def windows(t):
    return c.with_training_window(order_months(t)).drop("months_since_start")


@registry.add(
    "training_due",
    out="snapshot_date training_due",
    sql=f"""WITH {_ORDER_MONTHS} SELECT snapshot_date, snapshot_date >= DATE '{FIRST_TRAINING}' AND
      date_diff('month', DATE '{FIRST_TRAINING}', snapshot_date) % 3 = 0 AS training_due FROM months""",
)
def due(t):
    return c.with_training_due(order_months(t), FIRST_TRAINING, 3).drop("months_since_start")


@registry.add(
    "execution_paths",
    out="snapshot_date training_due run_inference run_monitoring execution_path",
    sql=f"""WITH {_ORDER_MONTHS} SELECT *, CASE WHEN NOT run_inference THEN 'skip_to_reporting' WHEN training_due THEN 'training_start'
        WHEN snapshot_date >= DATE '1999-03-01' THEN 'inference_only_start' ELSE 'skip_to_reporting' END AS execution_path
      FROM (SELECT snapshot_date, s AND date_diff('month', DATE '{FIRST_TRAINING}', snapshot_date) % 6 = 0 AS training_due,
          s AS run_inference, s AS run_monitoring
        FROM (SELECT snapshot_date, snapshot_date >= DATE '{FIRST_TRAINING}' AS s FROM months))""",
)
def paths(t):
    trained = t.predictions.select("model_version").distinct()
    trained = with_version_parts(trained).withColumn("training_date", F.add_months("training_date", 2))
    runs = c.with_training_due(order_months(t), FIRST_TRAINING, 6)
    return c.with_execution_path(runs, trained, FIRST_TRAINING).drop("months_since_start")


@registry.add(
    "monitoring_windows",
    out="snapshot_date monitoring_start monitoring_end",
    sql=f"""WITH {_ORDER_MONTHS} SELECT snapshot_date, snapshot_date - 30 AS monitoring_start,
      snapshot_date AS monitoring_end FROM months""",
)
def monitoring_windows(t):
    return c.with_monitoring_window(order_months(t)).drop("months_since_start")


@registry.add(
    "backfill_report",
    out="snapshot_date records:i success",
    views="loans",
    sql=f"""WITH {_ORDER_MONTHS} SELECT snapshot_date, coalesce(n, 0) AS records, coalesce(n, 0) > 0 AS success FROM months
      LEFT JOIN (SELECT snapshot_date, count(*) AS n FROM loans GROUP BY 1) USING (snapshot_date)""",
)
def backfill(t):
    return stores.backfill_report(t.loans, order_months(t).drop("months_since_start"))


@registry.add(
    "scoring_backfill_report",
    out="snapshot_date records:i success",
    views="predictions",
    sql=f"""WITH {_ORDER_MONTHS} SELECT snapshot_date, coalesce(n, 0) AS records, coalesce(n, 0) > 0 AS success FROM months
      LEFT JOIN (SELECT CAST(snapshot_date AS DATE) AS snapshot_date, count(*) AS n FROM predictions
        WHERE model_version = '{MODEL_VERSIONS[0]}' GROUP BY 1) USING (snapshot_date)""",
)
def scoring_backfill(t):
    one_model = t.predictions.where(F.col("model_version") == MODEL_VERSIONS[0])
    dated = one_model.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    return stores.backfill_report(dated, order_months(t).drop("months_since_start"))


@registry.add(
    "run_summaries",
    out="table_name records:i columns:i feature_columns:i",
    views="silver_loans label_store silver_clickstream",
    sql="""SELECT 'silver_ledger' AS table_name, count(*) AS records, 15 AS columns, 15 AS feature_columns FROM silver_loans
      UNION ALL SELECT 'label_store_30dpd_6mob', count(*), 5, 5 FROM label_store
      UNION ALL SELECT 'silver_clickstream', count(*), 8, 4 FROM silver_clickstream""",
)
def summaries(t):
    rows = ledger.silver_ledger(t.loans)
    parts = [
        stores.run_summary(rows, "silver_ledger"),
        stores.run_summary(ledger.label_store(rows), "label_store_30dpd_6mob"),
        stores.run_summary(silver.silver_clickstream(t.clickstream), "silver_clickstream", "fe_"),
    ]
    return stores.union_snapshots(parts)


@registry.add(
    "union_of_snapshots",
    out="snapshot_date rows:i fe_1:f",
    views="clickstream",
    sql="""SELECT snapshot_date, count(*) AS rows, sum(fe_1) AS fe_1 FROM clickstream
      WHERE snapshot_date IN (DATE '1998-01-01', DATE '1998-02-01', DATE '1998-03-01') GROUP BY 1""",
)
def union(t):
    days = ("1998-01-01", "1998-02-01", "1998-03-01")
    together = stores.union_snapshots([stores.snapshot_slice(t.clickstream, d) for d in days])
    return together.groupBy("snapshot_date").agg(F.count("*").alias("rows"), F.sum("fe_1").alias("fe_1"))


@registry.add(
    "prediction_partition_check",
    out="available records:i",
    views="predictions",
    sql=f"""SELECT count(*) > 0 AS available, count(*) AS records FROM predictions
      WHERE model_version = '{MODEL_VERSIONS[2]}' AND snapshot_date = '1999-07-01'""",
)
def partition(t):
    return stores.partition_check(
        t.predictions, MODEL_VERSIONS[2], "1999-07-01", count_files=False
    )


@registry.add(
    "prediction_store_summary",
    out="model_version total_records:i dates:i min_date max_date avg_records_per_date:f",
    views="predictions",
    sql="""SELECT model_version, count(*) AS total_records, count(DISTINCT snapshot_date) AS dates,
      CAST(min(snapshot_date) AS DATE) AS min_date, CAST(max(snapshot_date) AS DATE) AS max_date,
      count(*)::DOUBLE / count(DISTINCT snapshot_date) AS avg_records_per_date FROM predictions GROUP BY 1""",
)
def prediction_summary(t):
    return stores.prediction_store_summary(t.predictions)


_AVAILABLE = """SELECT f > 0 AS feature_store_available, l > 0 AS label_store_available, f AS feature_record_count, l AS label_record_count,
  f > 0 AND l > 0 AS validation_passed, CASE WHEN f > 0 AND l > 0 THEN 'Both feature and label stores are available'
    WHEN f > 0 THEN 'Only feature store is available' WHEN l > 0 THEN 'Only label store is available'
    ELSE 'Neither feature nor label store is available' END AS validation_message FROM """
_AVAILABLE_OUT = """feature_store_available label_store_available feature_record_count:i label_record_count:i validation_passed
  validation_message"""


@registry.add(
    "store_availability",
    out=_AVAILABLE_OUT,
    views="feature_store label_store",
    sql=_AVAILABLE + "(SELECT (SELECT count(*) FROM feature_store) AS f, (SELECT count(*) FROM label_store) AS l)",
)
def store_availability(t):
    return stores.store_availability(full_store(t), labels(t))


@registry.add(
    "store_availability_without_labels",
    out=_AVAILABLE_OUT,
    views="universe",
    sql=_AVAILABLE + f"(SELECT (SELECT count(*) FROM universe WHERE d = DATE '{DAY}') AS f, 0 AS l)",
)
def availability_without_labels(t):
    features = full_store(t).where(F.col("feature_snapshot_date") == F.lit(DAY).cast("date"))
    return stores.store_availability(features, labels(t).where("label_def = 'none'"))


@registry.add(
    "empty_feature_set_in_union",
    out="Customer_ID clickstream_record_count:i fe_1_mean:f",
    views="clickstream_features",
    sql=f"SELECT Customer_ID, clickstream_record_count, fe_1_mean FROM clickstream_features WHERE d = DATE '{DAY}'",
)
def empty_union(t):
    filled = clickstream_aggregates(lookback_slice(silver_sources(t)[0], DAY))
    empty = empty_features(t.spark, "clickstream", ["fe_1", "fe_2", "fe_3", "fe_4"])
    return filled.unionByName(empty).select("Customer_ID", "clickstream_record_count", "fe_1_mean")


@registry.add(
    "labels_per_class",
    out='label:i "count":i',
    views="label_store",
    sql="SELECT label, count(*) AS count FROM label_store GROUP BY 1",
)
def per_class(t):
    return stores.group_counts(labels(t), "label").orderBy("label")


@registry.add(
    "features_per_snapshot",
    out='feature_snapshot_date "count":i',
    views="universe",
    sql="SELECT d AS feature_snapshot_date, count(*) AS count FROM universe GROUP BY 1",
)
def per_snapshot(t):
    return stores.group_counts(full_store(t), "feature_snapshot_date").orderBy("feature_snapshot_date")


@registry.add(
    "source_coverage",
    out="clickstream_coverage:f attributes_coverage:f financial_coverage:f avg_completeness:f",
    views="feature_store",
    sql="""SELECT avg(has_clickstream_data::DOUBLE) AS clickstream_coverage, avg(has_attributes_data::DOUBLE) AS attributes_coverage,
      avg(has_financial_data::DOUBLE) AS financial_coverage, avg(data_completeness_score) AS avg_completeness FROM feature_store""",
)
def coverage(t):
    return stores.coverage(full_store(t))


@registry.add(
    "date_ranges",
    out="source min_date max_date dates:i",
    views="clickstream loans",
    sql="""SELECT 'clickstream' AS source, min(snapshot_date) AS min_date, max(snapshot_date) AS max_date,
      count(DISTINCT snapshot_date) AS dates FROM clickstream UNION ALL
      SELECT 'loans', min(snapshot_date), max(snapshot_date), count(DISTINCT snapshot_date) FROM loans""",
)
def date_ranges(t):
    ranges = [
        stores.date_range(df).withColumn("source", F.lit(name))
        for name, df in (("clickstream", t.clickstream), ("loans", t.loans))
    ]
    return stores.union_snapshots(ranges)


@registry.add(
    "training_window_of_both_stores",
    out="store rows:i",
    views="universe label_store",
    sql="""SELECT 'features' AS store, count(*) AS rows FROM universe WHERE d BETWEEN DATE '1997-11-01' AND DATE '1998-12-31'
      UNION ALL SELECT 'labels', count(*) FROM label_store WHERE snapshot_date BETWEEN DATE '1997-11-01' AND DATE '1998-12-31'""",
)
def both_stores(t):
    features, found = stores.load_training_window(full_store(t), labels(t), "1997-11-01", "1998-12-31")
    counted = [
        df.agg(F.count("*").alias("rows")).withColumn("store", F.lit(name))
        for name, df in (("features", features), ("labels", found))
    ]
    return stores.union_snapshots(counted)


@registry.add(
    "score_summary",
    out="""rows:i min_score:f max_score:f positives:i negatives:i missing_labels:i missing_labels_pct:f missing_scores:i
      missing_scores_pct:f""",
    views="monitored",
    sql="""SELECT count(*) AS rows, min(model_prediction_proba) AS min_score, max(model_prediction_proba) AS max_score,
      count(*) FILTER (actual_label = 1) AS positives, count(*) FILTER (actual_label = 0) AS negatives,
      count(*) FILTER (actual_label IS NULL) AS missing_labels, 0.0 AS missing_labels_pct,
      count(*) FILTER (model_prediction_proba IS NULL) AS missing_scores, 0.0 AS missing_scores_pct FROM monitored""",
)
def summary_of_scores(t):
    return score_summary(scores(t), "model_prediction_proba", "actual_label")


