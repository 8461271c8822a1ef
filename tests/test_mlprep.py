import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermart.operators import mlprep, training
from ledgermart.operators.calendar import month_calendar, training_window, with_enough_history
from ledgermart.operators.features import empty_features
from ledgermart.sources import stores


@pytest.fixture(scope="module")
def loans(spark):
    """A third of all rows share one date, so the cut has to fall inside it."""
    rng = np.random.default_rng(9)
    days = [dt.date(2024, 1 + m, 1) for m in (0, 1, 1, 1, 2, 3)]
    rows = [(f"L{i:04d}", days[i % 6], int(rng.random() < 0.25)) for i in rng.permutation(501)]
    return spark.createDataFrame(rows, "loan_id string, snapshot_date date, label int").repartition(4)


@pytest.mark.parametrize("ratio", [0.8, 0.5, 0.3, 0.99])
def test_ordered_split(loans, ratio):
    found = mlprep.with_ordered_split(loans, ratio).collect()
    ordered = sorted(found, key=lambda r: (r.snapshot_date, r.loan_id))
    train = len(ordered) - mlprep.test_rows(len(ordered), ratio)
    assert [r.split for r in ordered] == ["train"] * train + ["test"] * (len(ordered) - train)


def test_folds_are_even_in_every_class(loans):
    folded = mlprep.with_folds(loans, 3, seed=88)
    counts = {(r.label, r.fold): r["count"] for r in folded.groupBy("label", "fold").count().collect()}
    for label in (0, 1):
        sizes = [counts[label, k] for k in range(3)]
        assert max(sizes) - min(sizes) <= 1
    again = mlprep.with_folds(loans.repartition(2), 3, seed=88)
    assert folded.select("loan_id", "fold").exceptAll(again.select("loan_id", "fold")).count() == 0


def test_training_window(spark):
    window = training_window(spark, "2024-09-01")
    assert (window.train_test_start, window.train_test_end) == ("2023-07-01", "2024-06-30")
    assert (window.oot_start, window.oot_end) == ("2024-07-01", "2024-08-31")


def test_calendar(spark):
    months = month_calendar(spark, "2023-01-15", "2024-12-01")
    assert months.count() == 24
    assert str(with_enough_history(months, 6).orderBy("snapshot_date").first()[0]) == "2023-07-01"


def test_training_rows_keep_every_label(spark):
    labels = spark.createDataFrame(
        [("l", "c", 1, "d", dt.date(2024, 1, 1)), ("k", "x", 0, "d", dt.date(2024, 1, 1))],
        "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date",
    )
    features = spark.createDataFrame(
        [("c", "2024-01-01", 5), ("c", "2024-02-01", 6)],
        "Customer_ID string, feature_snapshot_date string, age int",
    )
    joined = {r.Customer_ID: r.age for r in mlprep.training_rows(labels, features).collect()}
    assert joined == {"c": 5, "x": None}


def test_encodings(spark):
    train = spark.createDataFrame([("b",), ("a",), ("o'c",), (None,), ("a",)], "t string")
    levels = mlprep.fit_levels(train, ["t"])["t"]
    assert levels == ["a", "b", "o'c"]
    new = spark.createDataFrame([("a",), ("o'c",), ("new",), (None,)], "t string")
    hot = [F.expr(e).alias(f"c{i}") for i, e in enumerate(mlprep.one_hot("t", levels).values())]
    assert [tuple(r) for r in new.select(hot).collect()] == [(0, 0), (0, 1), (0, 0), (0, 0)]
    codes = new.select(F.expr(mlprep.level_code("t", levels)))
    assert [r[0] for r in codes.collect()] == [0, 2, 0, 0]
    assert mlprep.fit_modes(train, ["t"]) == {"t": "a"}


def test_imputation_and_scale(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0), (2.0, 5.0), (float("nan"), 5.0), (None, 5.0)], "x double, k double"
    )
    assert mlprep.fit_medians(df, ["x"]) == {"x": 1.5}
    filled = mlprep.imputed(df, {"x": 1.5}, {})
    assert [r.x for r in filled.collect()] == [1.0, 2.0, 1.5, 1.5]
    assert [r.x for r in mlprep.sentinel_filled(df, ["x"]).collect()][2:] == [-999.0, -999.0]
    scale = mlprep.fit_scale(filled, ["x", "k"])
    assert scale["x"] == pytest.approx((1.5, np.std([1, 2, 1.5, 1.5])))
    constant = F.expr(mlprep.standardized("k", *scale["k"]))
    assert {r[0] for r in filled.select(constant).collect()} == {0.0}


def test_column_choice(spark):
    store = [
        *empty_features(spark, "financials").columns,
        *empty_features(spark, "attributes").columns[1:],
        *empty_features(spark, "clickstream", [f"fe_{i}" for i in range(1, 21)]).columns[1:],
        "has_clickstream_data", "has_financial_data", "data_completeness_score", "loan_id", "label",
    ]
    regression = mlprep.regression_columns(store)
    clicks = [c for c in regression if c.startswith("fe_")]
    assert clicks == [f"fe_{i}_{s}" for i in (1, 2, 3, 5, 7) for s in ("mean", "std")]
    forest = mlprep.forest_columns(store)
    assert len(forest) == len(set(forest))
    assert {"annual_income", "fe_20_cv", "age_group", "has_clickstream_data"} <= set(forest)
    assert not {"loan_id", "label", "Customer_ID"} & set(mlprep.boosting_columns(store) + forest)


def test_f_statistic(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=90), rng.integers(0, 2, 90)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, label int")
    groups = [x[y == k] for k in (0, 1)]
    between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in groups)
    inside = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(x) - 2)
    assert mlprep.f_statistics(df, ["x"]).first().f_statistic == pytest.approx(between / inside)


def test_parameters(spark):
    drawn = training.drawn_parameters("xgb", 10, 88)
    assert len(drawn) == 10 and drawn == training.drawn_parameters("boost", 10, 88)
    estimator = training.base_estimator("lr")
    mapped = {p.name: v for p, v in training.parameter_map("lr", estimator, {"C": 2, "penalty": "l1"}, 50).items()}
    assert mapped["regParam"] == pytest.approx(0.01) and mapped["elasticNetParam"] == 1.0
    with pytest.raises(ValueError):
        training.family("svm")
    with pytest.raises(ValueError, match="solver_name"):
        training.parameter_map("lr", estimator, {"solver_name": "x"}, 50)


def test_store_format(spark):
    good = spark.createDataFrame([], "Customer_ID string, feature_snapshot_date date, age int")
    assert stores.is_feature_store(good)
    assert not stores.is_feature_store(good.drop("feature_snapshot_date"))


def test_store_round_trip(spark, tmp_path):
    path = str(tmp_path / "store")
    assert stores.read_or_empty(spark, path, "a int").count() == 0
    first = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-01")], "a int, snapshot_date string")
    stores.write_snapshots(first, path)
    stores.write_snapshots(first.where("a = 2").withColumn("a", F.lit(5)), path)
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1, 5]
    assert stores.read_store(spark, path, "2024-02-01", "2024-02-28").first().a == 5


def test_ordered_split_settles_equal_keys(spark):
    rows = spark.range(10).select(
        F.lit("2024-01-01").cast("date").alias("snapshot_date"), F.lit("L1").alias("loan_id"), F.col("id").alias("x")
    )
    sizes = {r.split: r["count"] for r in mlprep.with_ordered_split(rows).groupBy("split").count().collect()}
    assert sizes == {"train": 8, "test": 2}


def test_folds_keep_rows_without_a_label(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 0), ("c", None), ("d", 1)], "loan_id string, label int")
    rows = rows.withColumn("snapshot_date", F.lit("2024-01-01").cast("date"))
    assert mlprep.with_folds(rows, 2, 1).count() == 4


def test_split_rows_are_ordered_once(spark, small_dir):
    from ledgermart.registry import mlprep as queries
    from ledgermart.sources.sample_tables import SampleTables

    plan = queries.split_rows(SampleTables(spark, small_dir))._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan and "Window" not in plan and "Exchange" not in plan
