import datetime as dt

import numpy as np
import pytest

from ledgermart.operators import features as f
from ledgermart.operators import silver

D = dt.date


@pytest.fixture(scope="module")
def clicks(spark):
    rows = [
        ("a", D(2023, 12, 1), 100.0),  # seven months before July: outside
        ("a", D(2024, 1, 1), 1.0),
        ("a", D(2024, 7, 1), 3.0),
        ("a", D(2024, 8, 1), 50.0),  # later than July
        ("z", D(2024, 5, 1), 0.0),
        ("single", D(2024, 6, 1), 4.0),
        (None, D(2024, 6, 1), 4.0),
    ]
    return spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, fe_1 float")


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        ("a", "30", "111-11-1111", "Doctor", D(2024, 1, 1)),
        ("a", "31_", "111-11-1111", "Doctor", D(2024, 6, 1)),
        ("a", "99", "111-11-1111", "Doctor", D(2024, 9, 1)),
        ("only", None, "#F%$D@*&8", "_______", D(2024, 2, 1)),
        (None, "40", "1", "Writer", D(2024, 2, 1)),
    ]
    schema = "Customer_ID string, Age string, SSN string, Occupation string, snapshot_date date"
    return silver.silver_attributes(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def money(spark):
    schema = (
        "Customer_ID string, Annual_Income string, Monthly_Inhand_Salary double, Num_of_Loan string, "
        "Num_of_Delayed_Payment string, Outstanding_Debt string, Credit_Mix string, Payment_of_Min_Amount string, "
        "Credit_History_Age string, Credit_Utilization_Ratio double, Delay_from_due_date int, "
        "Total_EMI_per_month double, Amount_invested_monthly double, Monthly_Balance double, snapshot_date date"
    )
    rows = [
        ("a", "1000_", 50.0, "3", "7", "500", "Good", "NM", "2 Years and 1 Months", 31.0, None, 10.0, 1.0, 1.0, D(2024, 3, 1)),
        ("rich", "0", 0.0, "1", None, "5", "_", "Yes", "3 Months", 10.0, None, 1.0, 1.0, 1.0, D(2024, 7, 1)),
    ]
    return silver.silver_financials(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def july(spark, clicks, people, money):
    return {r.Customer_ID: r for r in f.feature_store(clicks, people, money, "2024-07-01").collect()}


def test_lookback_includes_both_ends(july):
    assert july["a"].clickstream_record_count == 2
    assert (july["a"].fe_1_mean, july["a"].fe_1_min, july["a"].fe_1_max) == (2.0, 1.0, 3.0)
    assert july["a"].clickstream_time_span_days == 182


def test_variation_of_zero_mean_and_of_one_row(july):
    assert july["z"].fe_1_cv == 0.0
    assert july["single"].fe_1_std is None and july["single"].fe_1_cv is None


def test_latest_record_is_never_from_the_future(july):
    assert july["a"].age == 31
    assert july["a"].occupation_category == "Professional"


def test_universe_and_availability(july):
    assert set(july) == {"a", "z", "single", "only", "rich", None}
    assert july["only"].has_attributes_data == 0  # age is unknown
    assert july["only"].age_group == "Unknown"
    assert july["a"].data_completeness_score == 1.0
    assert july[None].age is None and july[None].data_completeness_score == 0.0


def test_financial_flags(july):
    a, rich = july["a"], july["rich"]
    assert (a.high_credit_utilization, a.high_debt_burden, a.payment_issues) == (1, 1, 1)
    assert a.payment_of_min_amount == "No"
    assert a.financial_health_score == pytest.approx(0.2)
    assert rich.debt_to_income_ratio is None and rich.high_debt_burden == 0
    assert rich.credit_history_months is None and rich.payment_issues == 0
    assert rich.financial_health_score == pytest.approx(0.8)


def test_interactions(july):
    a = july["a"]
    assert a.age_income_interaction == pytest.approx(0.031)
    assert a.relative_credit_history == pytest.approx(25 / 31)
    assert a.age_adjusted_debt_ratio == pytest.approx(0.5 * 31 / 40)
    assert july["rich"].age_adjusted_debt_ratio is None


def test_backfill_equals_each_snapshot(spark, clicks, people, money):
    every = f.feature_store_backfill(clicks, people, money, "2024-01-01", "2024-10-01").collect()
    assert len({(r.Customer_ID, r.feature_snapshot_date) for r in every}) == len(every)
    for day in ("2024-01-01", "2024-06-01", "2024-07-01", "2024-10-01"):
        one = f.feature_store(clicks, people, money, day)
        columns = one.columns
        wanted = {tuple(r) for r in one.collect()}
        got = {tuple(r[c] for c in columns) for r in every if str(r.feature_snapshot_date) == day}
        assert got == wanted


def test_backfill_moves_and_broadcasts_no_spread_rows(spark, clicks, people, money):
    store = f.feature_store_backfill(clicks, people, money, "2024-01-01", "2024-10-01")
    for frame in (store, store.groupBy().count()):
        plan = frame._jdf.queryExecution().executedPlan().toString().split("Generate explode", 1)[0]
        assert "Broadcast" not in plan
        moved = [line for line in plan.splitlines() if "Exchange" in line and "SinglePartition" not in line]
        assert all("REPARTITION_BY_NUM" in line for line in moved)


def test_tasks_of_a_backfill_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(f, "ROWS_PER_TASK", 100)
    days = [(str(i), D(2024, 1 + i % 12, 1), float(i)) for i in range(200)]
    df = spark.createDataFrame(days, "Customer_ID string, snapshot_date date, fe_1 double")
    tasks = f.backfill_partitions("2024-01-01", "2024-12-01", df)
    assert 20 <= tasks <= 28
    every = f.clickstream_backfill(df, "2024-01-01", "2024-12-01")
    assert every.rdd.getNumPartitions() > 15


def test_universe_of_the_statistics(spark):
    clicks = spark.createDataFrame(
        [("a", D(2024, 1, 1), 2.0), ("b", D(2024, 1, 1), None), (None, D(2024, 1, 1), 5.0)],
        "Customer_ID string, snapshot_date date, fe_1 double",
    )
    wanted = spark.createDataFrame(
        [(c, D(2024, m, 1)) for c in ("a", "b", "c", None) for m in (1, 2, 3, 4)], "Customer_ID string, snapshot date"
    ).repartition(2, "Customer_ID")
    got = f.clickstream_backfill(clicks, "2024-01-01", "2024-04-01", 2, partitions=2, universe=wanted).collect()
    assert len(got) == 16
    for r in got:
        seen = r.Customer_ID in ("a", "b") and r.snapshot < D(2024, 4, 1)
        assert r.clickstream_record_count == (1 if seen else None)
        assert r.fe_1_mean == (2.0 if seen and r.Customer_ID == "a" else None)
        assert (r.fe_1_cv is None) == (not seen or r.Customer_ID == "a")


def test_tie_on_a_date_is_stable(spark):
    rows = [("a", D(2024, 1, 1), v) for v in ("x", "y", "z")]
    schema = "Customer_ID string, snapshot_date date, v string"
    picks = {
        f.latest_record(spark.createDataFrame(order, schema).repartition(n)).first().v
        for n, order in ((1, rows), (3, rows[::-1]))
    }
    assert len(picks) == 1


def test_empty_sources_keep_all_columns(spark, clicks, people, money):
    nothing = spark.createDataFrame([], people.schema)
    store = f.feature_store(clicks, nothing, money, "2024-07-01")
    assert store.where("Customer_ID = 'a'").first().age is None
    for kind in ("clickstream", "attributes", "financials"):
        empty = f.empty_features(spark, kind, ["fe_1"])
        assert empty.count() == 0 and "Customer_ID" in empty.columns
    assert set(f.empty_features(spark, "clickstream", ["fe_1"]).columns) == set(
        f.clickstream_aggregates(clicks).columns
    )
    assert set(f.empty_features(spark, "attributes").columns) == set(f.attribute_features(people).columns)
    assert set(f.empty_features(spark, "financials").columns) == set(f.financial_features(money).columns)


def test_backfill_with_a_hot_customer(spark):
    """A third of all rows belong to one customer, many of them to the same date."""
    rng = np.random.default_rng(11)
    customers = np.where(rng.random(900) < 0.35, "hot", (rng.integers(0, 60, 900)).astype(str))
    months = rng.integers(0, 12, 900)
    values = np.where(rng.random(900) < 0.1, np.nan, rng.normal(1000, 3, 900).round(2))
    rows = [
        (str(c), D(2024, int(m) + 1, 1), None if np.isnan(v) else float(v), 7.0 if c == "hot" else float(m - 5))
        for c, m, v in zip(customers, months, values)
    ]
    df = spark.createDataFrame(
        rows, "Customer_ID string, snapshot_date date, fe_1 float, fe_2 float"
    )
    every = f.clickstream_backfill(df, "2024-03-01", "2024-12-01", months=3).collect()
    for day in ("2024-03-01", "2024-08-01", "2024-12-01"):
        wanted = {
            r.Customer_ID: r
            for r in f.clickstream_aggregates(f.lookback_slice(df, day, 3)).collect()
        }
        got = {r.Customer_ID: r for r in every if str(r.snapshot) == day}
        assert got.keys() == wanted.keys()
        for customer, row in wanted.items():
            for name, value in row.asDict().items():
                if isinstance(value, float):
                    assert got[customer][name] == pytest.approx(value, rel=1e-9, abs=1e-12), name
                else:
                    assert got[customer][name] == value, name
