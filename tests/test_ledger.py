import datetime as dt

from ledgermart.operators import ledger

SCHEMA = (
    "loan_id string, Customer_ID string, loan_start_date string, tenure string, installment_num string, "
    "loan_amt string, due_amt string, paid_amt string, overdue_amt string, balance string, snapshot_date string"
)


def loan(due="100", overdue="0", number="6", day="2024-03-31", name="L"):
    return (name, "C", "2023-09-01", "10", number, "1000", due, "0", overdue, "500", day)


def silver(spark, *rows):
    return ledger.silver_ledger(spark.createDataFrame(list(rows), SCHEMA)).collect()


def test_due_of_zero_leaves_dpd_unknown(spark):
    (row,) = silver(spark, loan(due="0", overdue="5"))
    assert (row.installments_missed, row.first_missed_date, row.dpd) == (0, None, None)


def test_missing_overdue_counts_as_nothing(spark):
    (row,) = silver(spark, loan(overdue=None))
    assert (row.overdue_amt, row.installments_missed, row.dpd) == (0.0, 0, 0)


def test_whole_and_single_precision_ratios(spark):
    assert silver(spark, loan(overdue="200"))[0].installments_missed == 2
    assert silver(spark, loan(due="33.3", overdue="99.9"))[0].installments_missed == 4


def test_exact_money_on_request(spark):
    raw = spark.createDataFrame([loan(due="33.3", overdue="99.9")], SCHEMA)
    assert ledger.silver_ledger(raw, "decimal(18,2)").first().installments_missed == 3


def test_month_end_is_clamped(spark):
    (row,) = silver(spark, loan(overdue="100"))
    assert row.first_missed_date == dt.date(2024, 2, 29)
    assert row.dpd == 31


def test_text_that_is_no_number_or_date(spark):
    (row,) = silver(spark, loan(number="six", day="soon"))
    assert (row.mob, row.installment_num, row.snapshot_date) == (0, 0, None)


def test_labels(spark):
    rows = [
        loan(overdue="100", name="bad"),
        loan(name="good"),
        loan(due="0", overdue="5", name="unknown"),
        loan(number="5", overdue="100", name="young"),
    ]
    raw = spark.createDataFrame(rows, SCHEMA)
    labels = ledger.label_store(ledger.silver_ledger(raw), dpd=30, mob=6)
    assert {r.loan_id: r.label for r in labels.collect()} == {"bad": 1, "good": 0, "unknown": 0}
    assert {r.label_def for r in labels.collect()} == {"30dpd_6mob"}


def test_bad_rate_known_values(spark):
    from ledgermart.registry import all_queries

    rows = all_queries()["bad_rate_by_month_on_book"](spark, "/root/testdata/sf0.01").collect()
    assert [(r.loans, r.bads) for r in rows] == [
        (6565, 1883), (6550, 1910), (6507, 1853), (6521, 1858), (6595, 1916), (6594, 1946), (6500, 1934),
    ]
