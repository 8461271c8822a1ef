import datetime as dt

import pytest

from ledgermart.operators import explore, profile


@pytest.fixture(scope="module")
def frame(spark):
    rows = [("a", 1.0, None), ("b", 2.0, None), ("b", 2.0, None), (None, 100.0, None)]
    return spark.createDataFrame(rows, "t string, x double, empty double")


def test_missing_and_duplicates(frame):
    found = {r.column: (r.missing, r.missing_pct) for r in profile.missing_values(frame).collect()}
    assert found == {"t": (1, 25.0), "empty": (4, 100.0)}
    assert profile.duplicate_rows(frame).first()[0] == 1
    assert profile.duplicate_rows(frame.limit(0)).first()[0] == 0


@pytest.mark.parametrize("values", [None, 1, 3])
def test_wide_duplicates_are_exact_when_fingerprints_clash(spark, monkeypatch, values):
    rows = [(i % 3, None if i % 2 else "t", float(i % 4), "a.b", i % 5) for i in range(90)]
    rows += [(None, None, None, None, None)] * 3 + [(7, "x", float("nan"), "", 0)] * 2 + [(8, "x", -0.0, "", 0), (8, "x", 0.0, "", 0)]
    df = spark.createDataFrame(rows, "n int, `_copies` string, x double, `a.b` string, row int")
    if values:  # so many different fingerprints only
        few = [profile.F.lit(0), profile.F.pmod(profile.F.coalesce("row", profile.F.lit(0)), profile.F.lit(values))]
        monkeypatch.setattr(profile, "_fingerprint", lambda columns: few)
    assert profile.duplicate_rows(df).first()[0] == (90 - 60) + 2 + 1 + 1
    assert profile.duplicate_rows(df.limit(0)).first()[0] == 0


def test_summaries_leave_out_columns_without_values(frame):
    assert [r.feature for r in profile.numeric_summary(frame, ["x", "empty"]).collect()] == ["x"]
    (text,) = profile.text_summary(frame, ["t"]).collect()
    assert (text["count"], text.unique, text.top, text.freq) == (3, 2, "b", 2)


def test_iqr(frame):
    (row,) = profile.iqr_outliers(frame, ["x"]).collect()
    assert (row.total_count, row.percentage, row.upper_count) == (1, 25.0, 1)


def test_stability_needs_two_months(spark):
    rows = [(dt.date(2024, 1, d), float(d)) for d in (1, 2, 3)]
    one = spark.createDataFrame(rows, "snapshot_date date, x double")
    assert profile.feature_stability(one, ["x"]).first().mean_coef_of_variation is None
    two = one.union(spark.createDataFrame([(dt.date(2024, 2, 1), 4.0)], one.schema))
    assert profile.feature_stability(two, ["x"]).first().mean_coef_of_variation == pytest.approx(
        2**0.5 / 3
    )


def test_variability(spark):
    rows = [(1.0, -1.0, 5.0), (3.0, 1.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, balanced double, constant double")
    found = {r.feature: r.cv for r in profile.feature_variability(df, df.columns).collect()}
    assert found["balanced"] == float("inf") and "constant" not in found


def test_quality_flags(spark):
    rows = [("c", None, 1)] * 9 + [("c", 1.0, 0)]
    df = spark.createDataFrame(rows, "Customer_ID string, x double, label int")
    report = profile.training_data_quality(df).first()
    assert report.data_quality_flags == [
        "HIGH_MISSING_VALUES", "IMBALANCED_LABELS", "SMALL_SAMPLE_SIZE", "HIGH_MISSING_FEATURES",
    ]
    assert report.majority_share == 0.9 and report.columns_with_missing == ["x"]


def test_mutual_information_of_copy_and_of_noise(spark):
    rows = [(float(i), float(i), float((i * 7919) % 1000)) for i in range(1000)]
    df = spark.createDataFrame(rows, "y double, copy double, noise double")
    found = {
        r.feature: r.mutual_information
        for r in profile.binned_mutual_information(df, ["copy", "noise"], "y").collect()
    }
    import math

    assert found["copy"] == pytest.approx(math.log(10))
    assert found["noise"] < 0.1


def test_latest_known_skips_missing(spark):
    rows = [("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 2, 1), None)]
    df = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, x double")
    row = explore.latest_known(df).first()
    assert (row.x, row.snapshot_date) == (1.0, dt.date(2024, 2, 1))


def test_sample_is_repeatable(spark):
    df = spark.range(500).selectExpr("cast(id % 100 as string) as k")
    first = [r.k for r in explore.sample_keys(df, "k", 7, 1).collect()]
    assert first == [r.k for r in explore.sample_keys(df.repartition(3), "k", 7, 1).collect()]
    assert len(set(first)) == 7
    assert first != [r.k for r in explore.sample_keys(df, "k", 7, 2).collect()]


def test_risk_score_parts(spark):
    schema = (
        "Annual_Income string, Outstanding_Debt string, Credit_History_Age string, Num_of_Delayed_Payment string, "
        "Credit_Mix string, Payment_of_Min_Amount string"
    )
    rows = [
        ("1000", "500", "20 Years and 0 Months", "0", "Good", "Yes"),
        ("0", "5", "1 Years", "40", "Bad", "No"),
        (None, "5", "1 Years", "1", "Bad", "No"),
    ]
    scored = explore.with_risk(spark.createDataFrame(rows, schema)).collect()
    assert scored[0].risk_score == pytest.approx(30 + 20 + 12.5 + 15)
    assert scored[0].risk_band == "Medium Risk"
    assert scored[1].risk_score == 0.0 and scored[1].risk_band is None
    assert scored[2].risk_score is None
