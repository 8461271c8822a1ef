"""Loan ledger and label queries."""

from pyspark.sql import functions as F

from ..operators import ledger
from .check import Registry

registry = Registry()

_TYPED = (
    "loan_id Customer_ID loan_start_date tenure:i installment_num:i loan_amt:f due_amt:f paid_amt:f "
    "overdue_amt:f balance:f snapshot_date"
)


def _as_text(df):
    """Raw files arrive as text; feed the typed ledger the same way."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@registry.add(
    "ledger_typed_from_text",
    out=_TYPED,
    views="loans",
    sql="""SELECT * REPLACE (loan_amt::FLOAT AS loan_amt, due_amt::FLOAT AS due_amt,
      paid_amt::FLOAT AS paid_amt, overdue_amt::FLOAT AS overdue_amt, balance::FLOAT AS balance) FROM loans""",
)
def typed(t):
    return ledger.typed_ledger(_as_text(t.loans))


@registry.add(
    "ledger_months_on_book",
    out="loan_id snapshot_date mob:i",
    views="silver_loans",
    sql="SELECT loan_id, snapshot_date, mob FROM silver_loans",
)
def months_on_book(t):
    typed = ledger.typed_ledger(t.loans)
    return ledger.with_months_on_book(typed).select("loan_id", "snapshot_date", "mob")


@registry.add(
    "ledger_installments_missed",
    out="loan_id installment_num:i due_amt:f overdue_amt:f installments_missed:i",
    views="silver_loans",
    sql="SELECT loan_id, installment_num, due_amt, overdue_amt, installments_missed FROM silver_loans",
)
def installments_missed(t):
    return ledger.with_installments_missed(ledger.typed_ledger(t.loans)).select(
        "loan_id", "installment_num", "due_amt", "overdue_amt", "installments_missed"
    )


@registry.add(
    "ledger_days_past_due",
    out="loan_id installment_num:i first_missed_date dpd:i",
    views="silver_loans",
    sql="SELECT loan_id, installment_num, first_missed_date, dpd FROM silver_loans",
)
def days_past_due(t):
    missed = ledger.with_installments_missed(ledger.typed_ledger(t.loans))
    return ledger.with_days_past_due(missed).select(
        "loan_id", "installment_num", "first_missed_date", "dpd"
    )


@registry.add(
    "silver_ledger",
    out=_TYPED + " mob:i installments_missed:i first_missed_date dpd:i",
    views="silver_loans",
    sql="SELECT * FROM silver_loans",
)
def silver(t):
    return ledger.silver_ledger(t.loans)


@registry.add(
    "label_store",
    out="loan_id Customer_ID label:i label_def snapshot_date",
    views="label_store",
    sql="SELECT * FROM label_store",
)
def labels(t):
    return ledger.label_store(ledger.silver_ledger(t.loans))


@registry.add(
    "bad_rate_by_month_on_book",
    out="mob:i loans:i bads:i bad_rate:f",
    views="silver_loans",
    sql="""SELECT mob, count(*) AS loans, sum(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS bads,
      avg(CASE WHEN dpd >= 30 THEN 1.0::DOUBLE ELSE 0 END) AS bad_rate FROM silver_loans GROUP BY mob""",
)
def bad_rate(t):
    return ledger.bad_rate_by_month(ledger.silver_ledger(t.loans))


@registry.add(
    "bad_rate_of_completed_loans",
    out="mob:i loans:i bads:i bad_rate:f",
    views="silver_loans",
    sql="""SELECT mob, count(*) AS loans, sum(CASE WHEN dpd >= 60 THEN 1 ELSE 0 END) AS bads,
      avg(CASE WHEN dpd >= 60 THEN 1.0::DOUBLE ELSE 0 END) AS bad_rate
      FROM silver_loans WHERE loan_start_date < DATE '2000-01-01' GROUP BY mob""",
)
def bad_rate_completed(t):
    return ledger.bad_rate_by_month(ledger.silver_ledger(t.loans), dpd=60, started_before="2000-01-01")


@registry.add(
    "loans_at_last_installment",
    out="loan_id Customer_ID snapshot_date dpd:i dpd_flag:i",
    views="silver_loans",
    sql="""SELECT loan_id, Customer_ID, snapshot_date, dpd, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS dpd_flag
      FROM silver_loans WHERE installment_num = 7""",
)
def last_installment(t):
    rows = ledger.loans_at_installment(ledger.silver_ledger(t.loans), 7)
    return rows.select("loan_id", "Customer_ID", "snapshot_date", "dpd", "dpd_flag")
