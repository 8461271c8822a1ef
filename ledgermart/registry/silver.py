"""Cleaning queries for the three feature sources."""

from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import silver
from .check import Registry

registry = Registry()

_FE = "fe_1:f fe_2:f fe_3:f fe_4:f"
_KEYS = "Customer_ID snapshot_date "


@registry.add(
    "silver_clickstream",
    out=_KEYS + _FE + " has_null_features feature_count:i",
    views="silver_clickstream",
    sql="SELECT * FROM silver_clickstream",
)
def clickstream(t):
    return silver.silver_features("clickstream", t.clickstream)


@registry.add(
    "prefix_columns_as_float",
    out=_KEYS + _FE,
    views="clickstream",
    sql="""SELECT Customer_ID, snapshot_date, fe_1::FLOAT AS fe_1, fe_2::FLOAT AS fe_2, fe_3::FLOAT AS fe_3,
      fe_4::FLOAT AS fe_4 FROM clickstream""",
)
def prefix_float(t):
    features = c.with_prefix(t.clickstream.columns, "fe_")
    return t.clickstream.select(
        "Customer_ID", "snapshot_date", *[c.as_float(F.col(f)).alias(f) for f in features]
    )


@registry.add(
    "null_feature_flags",
    out="has_null_features rows:i feature_count:i",
    views="silver_clickstream",
    sql="""SELECT has_null_features, count(*) AS rows, max(feature_count) AS feature_count
      FROM silver_clickstream GROUP BY has_null_features""",
)
def null_flags(t):
    return (
        silver.silver_clickstream(t.clickstream)
        .groupBy("has_null_features")
        .agg(F.count("*").alias("rows"), F.max("feature_count").alias("feature_count"))
    )


@registry.add(
    "silver_attributes",
    out=_KEYS + "Age Age_clean:i Age_valid SSN SSN_valid Occupation Occupation_clean data_quality_score:f",
    views="silver_attributes",
    sql="SELECT * FROM silver_attributes",
)
def attributes(t):
    return silver.silver_features("attributes", t.attributes)


@registry.add(
    "silver_financials",
    out=_KEYS
    + """Annual_Income Num_of_Loan Num_of_Delayed_Payment Outstanding_Debt Credit_Mix Payment_of_Min_Amount
      Credit_History_Age Type_of_Loan Annual_Income_clean:f Num_of_Loan_clean:f Num_of_Delayed_Payment_clean:f
      Outstanding_Debt_clean:f Credit_Mix_clean Payment_of_Min_Amount_clean Credit_History_Months:i
      Credit_Utilization_Ratio:f Delay_from_due_date:i Total_EMI_per_month:f Monthly_Inhand_Salary:f
      Amount_invested_monthly:f Monthly_Balance:f debt_to_income_ratio:f emi_to_income_ratio:f""",
    views="silver_financials",
    sql="SELECT * FROM silver_financials",
)
def financials(t):
    return silver.silver_features("financials", t.financials)


@registry.add(
    "numbers_without_underscores",
    out=_KEYS + "age:i income:f loans:f",
    views="attributes financials",
    sql="""SELECT Customer_ID, snapshot_date, trunc(TRY_CAST(replace(Age, '_', '') AS DOUBLE)) AS age,
      TRY_CAST(replace(Annual_Income, '_', '') AS FLOAT) AS income,
      TRY_CAST(replace(Num_of_Loan, '_', '') AS FLOAT) AS loans
      FROM attributes JOIN financials USING (Customer_ID, snapshot_date)""",
)
def numbers(t):
    return t.attributes.join(t.financials, ["Customer_ID", "snapshot_date"]).select(
        "Customer_ID",
        "snapshot_date",
        c.as_int(c.without_underscores(F.col("Age"))).alias("age"),
        c.as_float(c.without_underscores(F.col("Annual_Income"))).alias("income"),
        c.as_float(c.without_underscores(F.col("Num_of_Loan"))).alias("loans"),
    )


@registry.add(
    "attribute_validity",
    out=_KEYS + "age_valid ssn_valid occupation score:f",
    views="silver_attributes",
    sql="""SELECT Customer_ID, snapshot_date, Age_valid AS age_valid, SSN_valid AS ssn_valid,
      Occupation_clean AS occupation, data_quality_score AS score FROM silver_attributes""",
)
def validity(t):
    return silver.silver_attributes(t.attributes).select(
        "Customer_ID",
        "snapshot_date",
        F.col("Age_valid").alias("age_valid"),
        F.col("SSN_valid").alias("ssn_valid"),
        F.col("Occupation_clean").alias("occupation"),
        F.col("data_quality_score").alias("score"),
    )


@registry.add(
    "category_remap",
    out="credit_mix minimum:i rows:i",
    views="financials",
    sql="""SELECT CASE WHEN Credit_Mix = '_' THEN 'Unknown' ELSE Credit_Mix END AS credit_mix,
      CASE WHEN Payment_of_Min_Amount = 'Yes' THEN 1 ELSE 0 END AS minimum, count(*) AS rows
      FROM financials GROUP BY 1, 2""",
)
def remap(t):
    cleaned = silver.with_clean_financials(t.financials)
    pays = c.indicator(F.col("Payment_of_Min_Amount_clean") == "Yes")
    return cleaned.groupBy(F.col("Credit_Mix_clean").alias("credit_mix"), pays.alias("minimum")).agg(
        F.count("*").alias("rows")
    )


@registry.add(
    "credit_history_months",
    out=_KEYS + "strict:i lenient:i",
    views="financials",
    sql=r"""SELECT Customer_ID, snapshot_date, y * 12 + m AS strict,
      CASE WHEN Credit_History_Age IS NOT NULL THEN coalesce(y, 0) * 12 + m END AS lenient
      FROM (SELECT *, TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Years?', 1) AS INTEGER) AS y,
        coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Months?', 1) AS INTEGER), 0) AS m
        FROM financials)""",
)
def history(t):
    age = F.col("Credit_History_Age")
    return t.financials.select(
        "Customer_ID",
        "snapshot_date",
        c.duration_months(age).alias("strict"),
        c.duration_months(age, missing_years=0).alias("lenient"),
    )


@registry.add(
    "guarded_ratios",
    out=_KEYS + "debt_to_income:f emi_to_income:f",
    views="silver_financials",
    sql="""SELECT Customer_ID, snapshot_date, debt_to_income_ratio AS debt_to_income,
      emi_to_income_ratio AS emi_to_income FROM silver_financials""",
)
def ratios(t):
    return silver.silver_financials(t.financials).select(
        "Customer_ID",
        "snapshot_date",
        F.col("debt_to_income_ratio").alias("debt_to_income"),
        F.col("emi_to_income_ratio").alias("emi_to_income"),
    )


@registry.add(
    "explored_attributes",
    out=_KEYS + "Age_clean:f Age_valid Occupation_clean SSN_valid",
    views="attributes",
    sql=r"""SELECT Customer_ID, snapshot_date, a AS Age_clean, coalesce(a BETWEEN 18 AND 90, false) AS Age_valid,
      CASE WHEN regexp_full_match(Occupation, '_+') THEN 'Unknown' ELSE Occupation END AS Occupation_clean,
      NOT regexp_matches(coalesce(SSN, 'x'), '[^0-9\-]') AS SSN_valid
      FROM (SELECT *, TRY_CAST(replace(Age, '_', '') AS DOUBLE) AS a FROM attributes)""",
)
def explored_attributes(t):
    return silver.explored_attributes(t.attributes).select(
        "Customer_ID", "snapshot_date", "Age_clean", "Age_valid", "Occupation_clean", "SSN_valid"
    )


@registry.add(
    "explored_financials",
    out=_KEYS + """Annual_Income_clean:f Num_of_Loan_clean:f Num_of_Delayed_Payment_clean:f
      Outstanding_Debt_clean:f Credit_Mix_clean Credit_History_Months:i""",
    views="financials",
    sql=r"""SELECT Customer_ID, snapshot_date, TRY_CAST(replace(Annual_Income, '_', '') AS DOUBLE) AS Annual_Income_clean,
      TRY_CAST(replace(Num_of_Loan, '_', '') AS DOUBLE) AS Num_of_Loan_clean,
      TRY_CAST(replace(Num_of_Delayed_Payment, '_', '') AS DOUBLE) AS Num_of_Delayed_Payment_clean,
      TRY_CAST(replace(Outstanding_Debt, '_', '') AS DOUBLE) AS Outstanding_Debt_clean,
      CASE WHEN Credit_Mix = '_' THEN 'Unknown' ELSE Credit_Mix END AS Credit_Mix_clean,
      CASE WHEN Credit_History_Age IS NOT NULL THEN
        coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Years?', 1) AS INTEGER), 0) * 12
        + coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Months?', 1) AS INTEGER), 0) END
        AS Credit_History_Months FROM financials""",
)
def explored_financials(t):
    return silver.explored_financials(t.financials).select(
        "Customer_ID",
        "snapshot_date",
        *[f"{name}_clean" for name in silver.FINANCIAL_TEXT],
        "Credit_Mix_clean",
        "Credit_History_Months",
    )
