"""The whole lake on the smallest sample: stores, training, scoring, monitoring, monthly run."""

import pytest
from pyspark.sql import functions as F

from ledgermart.operators.features import feature_store
from ledgermart.operators.silver import silver_features
from ledgermart.plans import medallion, models, monthly
from ledgermart.plans.lake import Lake
from ledgermart.sources import stores
from ledgermart.sources.sample_tables import SampleTables

START, END, NEXT = "1997-01-01", "1999-01-01", "1999-02-01"
KINDS = ("clickstream", "attributes", "financials")


@pytest.fixture(scope="module")
def raw(spark, small_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    tables, paths = SampleTables(spark, small_dir), {}
    for source in ("loans", *KINDS):
        paths[source] = str(folder / f"{source}.csv")
        getattr(tables, source).toPandas().to_csv(paths[source], index=False)
    return paths


@pytest.fixture(scope="module")
def lake(spark, raw, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    medallion.run_medallion(spark, lake, raw, START, END)
    return lake


@pytest.fixture(scope="module")
def trained(spark, lake):
    return models.run_batch_training(
        spark, lake, [END], model_types=["lr"], draws=1, folds=2
    ).collect()


def _same_rows(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    rounded = [
        [F.round(F.col(c), 9).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.select(columns).dtypes]
        for df in (left, right)
    ]
    a, b = left.select(rounded[0]), right.select(rounded[1])
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def test_backfill_equals_single_snapshots(spark, lake):
    store = spark.read.parquet(lake.features)
    silver = [spark.read.parquet(lake.silver(kind)) for kind in KINDS]
    for day in ("1997-07-01", "1998-04-01", END):
        one = feature_store(*silver, day)
        written = store.where(F.col("feature_snapshot_date") == F.lit(day).cast("date"))
        assert one.count() > 0
        _same_rows(one, written)


def test_no_snapshot_before_the_history_is_long_enough(spark, lake):
    first = spark.read.parquet(lake.features).agg(F.min("feature_snapshot_date")).first()[0]
    assert str(first) == "1997-07-01"


def test_rerun_of_a_date_changes_nothing(spark, lake, raw):
    before = spark.read.parquet(lake.silver("clickstream")).count()
    medallion.ingest(spark, lake, "clickstream", raw["clickstream"], "1998-03-01", "1998-03-01")
    medallion.refine(spark, lake, "clickstream", "1998-03-01", "1998-03-01")
    assert spark.read.parquet(lake.silver("clickstream")).count() == before


def test_silver_from_text_equals_silver_from_types(spark, lake, small_dir):
    typed = silver_features("financials", SampleTables(spark, small_dir).financials)
    columns = ["Customer_ID", "snapshot_date", "Annual_Income_clean", "debt_to_income_ratio"]
    stored = spark.read.parquet(lake.silver("financials")).select(columns)
    _same_rows(stores.within(typed, START, END).select(columns), stored)


def test_training_leaves_a_registry_row(trained):
    (row,) = trained
    assert row.model_version == "credit_model_logistic_regression_1999_01_01"
    assert row.rows_train > row.rows_test > 0
    assert 0 <= row.auc_train <= 1
    assert row.cv_score is not None


def test_scoring_and_monitoring(spark, lake, trained):
    report = models.run_scoring(spark, lake, "1998-06-01", END).collect()
    assert len(report) == 8 and all(r.success for r in report)
    version = trained[0].model_version
    stored = spark.read.parquet(lake.predictions)
    check = stores.partition_check(stored, version, END).first()
    assert check.available and check.records > 0 and check.files >= 1
    summary = models.run_monitoring(spark, lake, "1998-06-01", END).collect()
    assert [r.model_version for r in summary] == [version]
    raised = stores.read_alerts(spark, lake.monitoring)
    assert raised.count() == summary[0].total_alerts


def test_monthly_run(spark, lake, raw, trained):
    plan = monthly.planned_run(spark, lake, NEXT, first_training=END)
    assert plan.execution_path == "inference_only_start"
    report = monthly.run_month(
        spark, lake, raw, NEXT, history_start=START, first_training=END
    ).collect()
    assert len(report) == 1
    assert report[0].components == 4
    assert report[0].model_training_status == "skipped"
    assert report[0].model_inference_status == "excellent"


def test_a_rerun_without_rows_of_a_date_clears_its_partition(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([("2024-01-01", 1), ("2024-02-01", 2), ("2024-03-01", 3)], "snapshot_date string, x int")
    dated = rows.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    stores.write_snapshots(dated, path, span=("2024-01-01", "2024-03-01"))
    stores.write_snapshots(dated.where("x = 1"), path, span=("2024-01-01", "2024-02-01"))
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 3]
    stores.write_snapshots(dated.where("x = 2"), path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_rejected_rows_are_kept_apart(spark, tmp_path):
    raw = spark.createDataFrame([("2024-01-01",), ("2024-01-15",), ("soon",), (None,)], "snapshot_date string")
    reasons = [r.reject_reason for r in medallion.rejected(raw).orderBy("reject_reason").collect()]
    assert reasons == ["not a first of month", "unreadable date", "unreadable date"]
