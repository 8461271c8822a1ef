"""Exploration of customers: loan types, a simulated risk score, overlaps, histories, samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import band, clip, duration_months, exclude, title_words, without_underscores
from ..functions.ordering import exact_quantiles

# fixed values: points, bands and brackets
MIX_POINTS = {"Good": 30, "Standard": 20, "Bad": 10, "_": 0}
PAYMENT_POINTS = {"Yes": 20, "No": 0, "NM": 10}
RISK_EDGES = [0, 40, 60, 80, 100]
RISK_LABELS = ["Very High Risk", "High Risk", "Medium Risk", "Low Risk"]
INCOME_EDGES = [0, 25000, 50000, 75000, 100000, 150000]
INCOME_LABELS = ["0-25K", "25K-50K", "50K-75K", "75K-100K", "100K-150K"]
UNSPECIFIED = ["", "nan", "_", "not specified"]


def _number(name: str) -> Column:
    return without_underscores(F.col(name)).try_cast("double")


def up_to(df: DataFrame, cutoff: str, date: str = "snapshot_date") -> DataFrame:
    """All records up to and including a date."""
    return df.where(F.col(date) <= F.lit(cutoff).cast("date"))


# --- finances ------------------------------------------------------------------------------------


def standard_loan_type(c: Column) -> Column:
    """Trimmed, in title case; blanks, placeholders and missing text become ``Not Specified``."""
    text = F.regexp_replace(F.lower(F.coalesce(c, F.lit("nan"))), r"^\s+|\s+$", "")
    return F.when(text.isin(UNSPECIFIED), "Not Specified").otherwise(title_words(text))


def _points(c: Column, points: dict[str, int]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in points.items() for x in pair])
    return F.coalesce(F.try_element_at(known, c), F.lit(0))


def risk_score() -> Column:
    """Simulated score 0-100 from raw finances; NULL where a part of it is missing."""
    income, debt = _number("Annual_Income"), _number("Outstanding_Debt")
    unbounded = F.when(debt > 0, F.lit(float("inf"))).when(debt < 0, F.lit(float("-inf")))
    dti = clip(F.when(income == 0, unbounded).otherwise(F.try_divide(debt, income)), 0.0, 1.0)
    history = duration_months(F.col("Credit_History_Age"), missing_years=0)
    total = (
        _points(F.col("Credit_Mix"), MIX_POINTS)
        + _points(F.col("Payment_of_Min_Amount"), PAYMENT_POINTS)
        + (1 - dti) * 25
        + clip(history / F.lit(240.0), 0.0, 1.0) * 15
        - clip(_number("Num_of_Delayed_Payment") / F.lit(20.0), 0.0, 1.0) * 20
    )
    return clip(total, 0.0, 100.0)


def with_risk(financials: DataFrame) -> DataFrame:
    """Add the simulated risk score and its band."""
    scored = financials.withColumn("risk_score", risk_score())
    return scored.withColumn("risk_band", band(F.col("risk_score"), RISK_EDGES, RISK_LABELS))


def income_bracket(income: Column) -> Column:
    return band(income, INCOME_EDGES, INCOME_LABELS)


def plausible_incomes(financials: DataFrame) -> DataFrame:
    """Income and loan numbers inside the range that a person can have."""
    numbers = financials.select(
        _number("Annual_Income").alias("annual_income"), _number("Num_of_Loan").alias("num_loans")
    )
    return numbers.where("annual_income > 0 AND annual_income < 150000 AND num_loans BETWEEN 0 AND 10")


def plausible_utilization(financials: DataFrame) -> DataFrame:
    """Credit utilisation and loan numbers inside their range."""
    numbers = financials.select(
        F.col("Credit_Utilization_Ratio").cast("double").alias("utilization"),
        _number("Num_of_Loan").alias("num_loans"),
    )
    return numbers.where("utilization BETWEEN 0 AND 100 AND num_loans BETWEEN 0 AND 10")


def loans_by_income(financials: DataFrame) -> DataFrame:
    """Mean, median and number of customers' loans per income bracket."""
    grouped = plausible_incomes(financials).withColumn(
        "income_bracket", income_bracket(F.col("annual_income"))
    )
    keys = ["income_bracket"]
    moments = grouped.groupBy(*keys).agg(
        F.avg("num_loans").alias("mean"), F.count("num_loans").alias("count")
    )
    return moments.join(exact_quantiles(grouped, keys, "num_loans", {"median": 0.5}), keys)


# --- customers across sources ----------------------------------------------------------------------


def overlaps(sources: Mapping[str, DataFrame], groups: Sequence[Sequence[str]]) -> DataFrame:
    """Customers that all sources of a group have in common, one row per group.

    Every customer is reduced to one row of presence flags, so one shuffle serves all groups.
    """
    tagged = reduce(
        DataFrame.union,
        [df.select(F.lit(name).alias("source"), "Customer_ID") for name, df in sources.items()],
    )
    flags = (
        tagged.where(F.col("Customer_ID").isNotNull())
        .groupBy("Customer_ID")
        .agg(*[F.max(F.col("source") == name).alias(name) for name in sources])
    )
    names = [" & ".join(group) for group in groups]
    counts = [F.count_if(reduce(Column.__and__, [F.col(s) for s in group])) for group in groups]
    wide = flags.agg(*[c.alias(n) for c, n in zip(counts, names)])
    return wide.unpivot([], names, "overlap", "customers")


def latest_known(df: DataFrame, key: str = "Customer_ID", date: str = "snapshot_date") -> DataFrame:
    """Per customer the newest value of every column that is not missing.

    The values of one row can come from different dates; equal dates are decided by the value.
    """
    columns = exclude(df.columns, key, date)
    newest = [
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(date).alias("_at"), F.col(c).alias("_value"))))
        .getField("_value")
        .alias(c)
        for c in columns
    ]
    return df.groupBy(key).agg(F.max(date).alias(date), *newest)


def merge_latest(frames: Mapping[str, DataFrame], key: str = "Customer_ID") -> DataFrame:
    """Full outer merge of the newest values of several sources; dates get the source's name."""
    renamed = [
        latest_known(df, key).withColumnRenamed("snapshot_date", f"snapshot_date_{name}")
        for name, df in frames.items()
    ]
    return reduce(lambda left, right: left.join(right, key, "full"), renamed)


def complete_with_target(
    target: DataFrame, column: str, features: Mapping[str, DataFrame], wanted: Sequence[str]
) -> DataFrame:
    """Target values with the newest feature values of their customer, rows without gaps only."""
    result = target.select("Customer_ID", column).dropna()
    for name, df in features.items():
        chosen = [c for c in wanted if c in df.columns]
        newest = latest_known(df.select("Customer_ID", "snapshot_date", *chosen))
        result = result.join(
            newest.select("Customer_ID", *[F.col(c).alias(f"{name}_{c}") for c in chosen]),
            "Customer_ID",
            "left",
        )
    return result.dropna()


def customer_history(df: DataFrame, customer: str, column: str) -> DataFrame:
    """One customer's values in date order."""
    return (
        df.where(F.col("Customer_ID") == customer)
        .select("Customer_ID", "snapshot_date", column)
        .orderBy("snapshot_date")
    )


def sample_keys(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """``k`` different keys drawn without replacement; the same seed draws the same keys."""
    order = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(order, key).limit(k)
