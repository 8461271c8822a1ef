"""Cleaned silver rows of the three feature sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    SSN_CHARACTERS,
    any_null,
    as_float,
    as_int,
    duration_months,
    exclude,
    flag,
    indicator,
    iso_day,
    placeholder_to_unknown,
    ratio_if_positive,
    replace_when,
    with_prefix,
    without_underscores,
)
from ..sources.schemas import FINANCIAL_FLOATS, FINANCIAL_TEXT


def silver_clickstream(raw: DataFrame, prefix: str = "fe_") -> DataFrame:
    """Feature columns as floats, with a flag for missing ones and their number."""
    features = with_prefix(raw.columns, prefix)
    others = exclude(raw.columns, "Customer_ID", "snapshot_date", *features)
    typed = raw.select(
        F.col("Customer_ID").cast("string").alias("Customer_ID"),
        iso_day(F.col("snapshot_date")).alias("snapshot_date"),
        *[as_float(F.col(c)).alias(c) for c in features],
        *others,
    )
    return typed.withColumns(
        {"has_null_features": any_null(features), "feature_count": F.lit(len(features))}
    )


def with_clean_attributes(raw: DataFrame) -> DataFrame:
    """Age as a number in range or not, occupation without placeholders, SSN well formed or not."""
    age = as_int(without_underscores(F.col("Age")))
    return raw.withColumns(
        {
            "Age_clean": age,
            "Age_valid": flag(age.between(18, 90)),
            "Occupation_clean": placeholder_to_unknown(F.col("Occupation")),
            "SSN_valid": flag(F.col("SSN").rlike(SSN_CHARACTERS)),
        }
    )


def silver_attributes(raw: DataFrame) -> DataFrame:
    """Cleaned demographics with a quality score: the share of three checks that pass."""
    known_job = indicator(F.col("Occupation_clean") != "Unknown")
    checks = F.col("Age_valid").cast("int") + F.col("SSN_valid").cast("int") + known_job
    return with_clean_attributes(raw).withColumns(
        {
            "Customer_ID": F.col("Customer_ID").cast("string"),
            "snapshot_date": iso_day(F.col("snapshot_date")),
            "data_quality_score": checks / F.lit(3.0),
        }
    )


def with_clean_financials(raw: DataFrame) -> DataFrame:
    """Numbers without underscores, known categories, credit history in months."""
    cleaned = {
        f"{name}_clean": as_float(without_underscores(F.col(name)))
        for name in FINANCIAL_TEXT
        if name in raw.columns
    }
    mix, minimum = F.col("Credit_Mix"), F.col("Payment_of_Min_Amount")
    cleaned |= {
        "Credit_Mix_clean": replace_when(mix, mix == "_", "Unknown"),
        "Payment_of_Min_Amount_clean": replace_when(minimum, minimum == "NM", "No"),
        "Credit_History_Months": duration_months(F.col("Credit_History_Age")),
    }
    return raw.withColumns(cleaned)


def silver_financials(raw: DataFrame) -> DataFrame:
    """Cleaned finances with debt-to-income and installment-to-salary ratios."""
    typed = with_clean_financials(raw).withColumns(
        {
            "Customer_ID": F.col("Customer_ID").cast("string"),
            "snapshot_date": iso_day(F.col("snapshot_date")),
            "Delay_from_due_date": as_int(F.col("Delay_from_due_date")),
            **{name: as_float(F.col(name)) for name in FINANCIAL_FLOATS},
        }
    )
    return typed.withColumns(
        {
            "debt_to_income_ratio": ratio_if_positive(
                F.col("Outstanding_Debt_clean"), F.col("Annual_Income_clean")
            ),
            "emi_to_income_ratio": ratio_if_positive(
                F.col("Total_EMI_per_month"), F.col("Monthly_Inhand_Salary")
            ),
        }
    )


def _number(name: str) -> Column:
    return without_underscores(F.col(name)).try_cast("double")


def explored_attributes(raw: DataFrame) -> DataFrame:
    """The exploratory cleaning of demographics.

    Ages keep their fraction, and an SSN is valid unless a foreign character is found in it.
    """
    foreign = F.coalesce(F.col("SSN"), F.lit("missing")).rlike(r"[^0-9\-]")
    return raw.withColumns(
        {
            "Age_clean": _number("Age"),
            "Age_valid": flag(_number("Age").between(18, 90)),
            "Occupation_clean": placeholder_to_unknown(F.col("Occupation")),
            "SSN_valid": ~foreign,
        }
    )


def explored_financials(raw: DataFrame) -> DataFrame:
    """The exploratory cleaning of finances.

    Numbers are double precision, and history without a year part counts from zero years.
    """
    mix = F.col("Credit_Mix")
    return raw.withColumns(
        {
            **{f"{name}_clean": _number(name) for name in FINANCIAL_TEXT},
            "Credit_Mix_clean": replace_when(mix, mix == "_", "Unknown"),
            "Credit_History_Months": duration_months(F.col("Credit_History_Age"), missing_years=0),
        }
    )


SILVER_BUILDERS = {
    "clickstream": silver_clickstream,
    "attributes": silver_attributes,
    "financials": silver_financials,
}


def silver_features(kind: str, raw: DataFrame) -> DataFrame:
    """Silver rows of one feature source by its name."""
    if kind not in SILVER_BUILDERS:
        raise ValueError(f"unknown feature source {kind!r}; known: {sorted(SILVER_BUILDERS)}")
    return SILVER_BUILDERS[kind](raw)
