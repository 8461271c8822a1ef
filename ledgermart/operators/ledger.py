"""Loan ledger: typed silver rows, delinquency and default labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.columns import as_int, indicator, iso_day
from ..sources.schemas import LOAN_TYPES


def typed_ledger(raw: DataFrame, amount_type: str = "float") -> DataFrame:
    """Enforce the ledger's column types; text that does not fit becomes NULL.

    Amounts are single precision by default; pass ``decimal(18,2)`` for exact money.
    """
    columns = []
    for name, kind in LOAN_TYPES.items():
        c = F.col(name)
        if kind == "int":
            c = as_int(c)
        elif kind == "date":
            c = iso_day(c)
        else:
            c = c.try_cast(amount_type if kind == "float" else kind)
        columns.append(c.alias(name))
    return raw.select(*columns)


def with_months_on_book(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("mob", F.col("installment_num").cast("int"))


def with_installments_missed(ledger: DataFrame) -> DataFrame:
    """Overdue amount in whole installments, rounded up; floats are divided in double precision.

    A zero installment gives NULL.  After that every NULL number of the row becomes 0.
    """
    exact = isinstance(ledger.schema["due_amt"].dataType, DecimalType)
    amounts = [F.col(c) if exact else F.col(c).cast("double") for c in ("overdue_amt", "due_amt")]
    ratio = F.try_divide(*amounts)
    return ledger.withColumn("installments_missed", F.ceil(ratio).try_cast("int")).fillna(0)


def with_days_past_due(ledger: DataFrame) -> DataFrame:
    """Date of the first missed installment and the days passed since then.

    ``dpd`` is NULL for an overdue amount that is not a full installment of anything (due 0).
    """
    missed = F.col("installments_missed")
    first = F.when(missed > 0, F.add_months("snapshot_date", -missed))
    ledger = ledger.withColumn("first_missed_date", first)
    overdue = F.col("overdue_amt") > 0
    days = F.datediff("snapshot_date", "first_missed_date")
    return ledger.withColumn("dpd", F.when(overdue, days).otherwise(0))


def silver_ledger(raw: DataFrame, amount_type: str = "float") -> DataFrame:
    """Typed ledger with months on book, installments missed and days past due."""
    ledger = with_months_on_book(typed_ledger(raw, amount_type))
    return with_days_past_due(with_installments_missed(ledger))


def label_store(silver: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Default label of every loan at one month on book."""
    return silver.where(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        indicator(F.col("dpd") >= dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def bad_rate_by_month(silver: DataFrame, dpd: int = 30, started_before: str | None = None) -> DataFrame:
    """Share of loans past due, per month on book."""
    if started_before is not None:
        silver = silver.where(F.col("loan_start_date") < F.lit(started_before).cast("date"))
    bad = indicator(F.col("dpd") >= dpd)
    return (
        silver.groupBy("mob")
        .agg(F.count("*").alias("loans"), F.sum(bad).alias("bads"), F.avg(bad).alias("bad_rate"))
        .orderBy("mob")
    )


def loans_at_installment(silver: DataFrame, number: int, dpd: int = 30) -> DataFrame:
    """Ledger rows at one installment with their past-due flag."""
    return silver.where(F.col("installment_num") == number).withColumn(
        "dpd_flag", indicator(F.col("dpd") >= dpd)
    )
