"""Customer-exploration queries."""

from pyspark.sql import functions as F

from ..functions.columns import iso_day
from ..operators import explore, silver
from ..sources.stores import within
from .check import Registry

registry = Registry()


@registry.add(
    "records_up_to_cutoff",
    out="Customer_ID snapshot_date fe_1:f",
    views="clickstream",
    sql="SELECT Customer_ID, snapshot_date, fe_1 FROM clickstream WHERE snapshot_date <= DATE '1997-03-01'",
)
def cutoff(t):
    return explore.up_to(t.clickstream, "1997-03-01").select("Customer_ID", "snapshot_date", "fe_1")


@registry.add(
    "records_within_window",
    out="loan_id installment_num:i snapshot_date",
    views="loans",
    sql="""SELECT loan_id, installment_num, snapshot_date FROM loans
      WHERE snapshot_date BETWEEN DATE '1997-03-01' AND DATE '1998-03-01'""",
)
def window(t):
    rows = within(t.loans, "1997-03-01", "1998-03-01")
    return rows.select("loan_id", "installment_num", "snapshot_date")


@registry.add(
    "event_days_from_timestamps",
    out="day events:i",
    sql="SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1",
)
def event_days(t):
    return t.table("events").groupBy(iso_day(F.col("ts")).alias("day")).agg(F.count("*").alias("events"))


@registry.add(
    "standard_loan_types",
    out="loan_type customers:i",
    views="financials",
    sql="""SELECT CASE WHEN s IN ('', 'nan', '_', 'not specified') THEN 'Not Specified' ELSE
        list_aggregate(list_transform(regexp_extract_all(s, '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), 'string_agg', '')
      END AS loan_type, count(*) AS customers
      FROM (SELECT trim(lower(coalesce(Type_of_Loan, 'nan'))) AS s FROM financials) GROUP BY 1""",
)
def loan_types(t):
    kind = explore.standard_loan_type(F.col("Type_of_Loan")).alias("loan_type")
    return t.financials.groupBy(kind).agg(F.count("*").alias("customers"))


_RISK = r"""SELECT Customer_ID, snapshot_date, CASE WHEN s < 0 THEN 0 WHEN s > 100 THEN 100 ELSE s END AS risk_score
  FROM (SELECT Customer_ID, snapshot_date,
      (CASE Credit_Mix WHEN 'Good' THEN 30 WHEN 'Standard' THEN 20 WHEN 'Bad' THEN 10 ELSE 0 END)
      + (CASE Payment_of_Min_Amount WHEN 'Yes' THEN 20 WHEN 'NM' THEN 10 ELSE 0 END)
      + (1 - CASE WHEN dti < 0 THEN 0 WHEN dti > 1 THEN 1 ELSE dti END) * 25
      + (CASE WHEN months > 240 THEN 1.0::DOUBLE ELSE months / 240.0::DOUBLE END) * 15
      - (CASE WHEN late > 20 THEN 1.0::DOUBLE WHEN late < 0 THEN 0 ELSE late / 20.0::DOUBLE END) * 20 AS s
    FROM (SELECT *, CASE WHEN income = 0 AND debt > 0 THEN 'inf'::DOUBLE WHEN income <> 0 THEN debt / income END AS dti,
        CASE WHEN Credit_History_Age IS NOT NULL THEN
          coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Years?', 1) AS INTEGER), 0) * 12
          + coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Months?', 1) AS INTEGER), 0) END AS months
      FROM (SELECT *, TRY_CAST(replace(Annual_Income, '_', '') AS DOUBLE) AS income,
          TRY_CAST(replace(Outstanding_Debt, '_', '') AS DOUBLE) AS debt,
          TRY_CAST(replace(Num_of_Delayed_Payment, '_', '') AS DOUBLE) AS late FROM financials)))"""
_RISK_BAND = """CASE WHEN risk_score > 0 AND risk_score <= 40 THEN 'Very High Risk'
  WHEN risk_score > 40 AND risk_score <= 60 THEN 'High Risk' WHEN risk_score > 60 AND risk_score <= 80 THEN 'Medium Risk'
  WHEN risk_score > 80 AND risk_score <= 100 THEN 'Low Risk' END"""


@registry.add(
    "simulated_risk_score",
    out="Customer_ID snapshot_date risk_score:f risk_band",
    views="financials",
    sql=f"SELECT *, {_RISK_BAND} AS risk_band FROM ({_RISK})",
)
def risk(t):
    return explore.with_risk(t.financials).select(
        "Customer_ID", "snapshot_date", "risk_score", "risk_band"
    )


@registry.add(
    "risk_band_counts",
    out="risk_band customers:i",
    views="financials",
    sql=f"SELECT {_RISK_BAND} AS risk_band, count(*) AS customers FROM ({_RISK}) GROUP BY 1",
)
def risk_bands(t):
    return explore.with_risk(t.financials).groupBy("risk_band").agg(F.count("*").alias("customers"))


@registry.add(
    "plausible_incomes",
    out="annual_income:f num_loans:f",
    views="financials",
    sql="""SELECT * FROM (SELECT TRY_CAST(replace(Annual_Income, '_', '') AS DOUBLE) AS annual_income,
      TRY_CAST(replace(Num_of_Loan, '_', '') AS DOUBLE) AS num_loans FROM financials)
      WHERE annual_income > 0 AND annual_income < 150000 AND num_loans BETWEEN 0 AND 10""",
)
def plausible(t):
    return explore.plausible_incomes(t.financials)


@registry.add(
    "loans_by_income_bracket",
    out="income_bracket mean:f count:i median:f",
    views="financials",
    sql="""SELECT CASE WHEN i <= 25000 THEN '0-25K' WHEN i <= 50000 THEN '25K-50K' WHEN i <= 75000 THEN '50K-75K'
        WHEN i <= 100000 THEN '75K-100K' ELSE '100K-150K' END AS income_bracket,
      avg(n) AS mean, count(n) AS count, median(n) AS median
      FROM (SELECT TRY_CAST(replace(Annual_Income, '_', '') AS DOUBLE) AS i,
        TRY_CAST(replace(Num_of_Loan, '_', '') AS DOUBLE) AS n FROM financials)
      WHERE i > 0 AND i < 150000 AND n BETWEEN 0 AND 10 GROUP BY 1""",
)
def by_income(t):
    return explore.loans_by_income(t.financials)


_SETS = {"clickstream": "c", "attributes": "a", "financials": "f", "loans": "l"}
_GROUPS = [
    ("clickstream", "attributes"),
    ("clickstream", "financials"),
    ("attributes", "financials"),
    ("clickstream", "attributes", "financials"),
    ("loans", "clickstream"),
    ("loans", "attributes"),
    ("loans", "financials"),
    ("loans", "clickstream", "attributes", "financials"),
]


@registry.add(
    "customer_overlaps",
    out="overlap customers:i",
    views="clickstream attributes financials loans",
    sql=" UNION ALL ".join(
        f"SELECT '{' & '.join(group)}' AS overlap, count(*) AS customers FROM ("
        + " INTERSECT ".join(f"SELECT Customer_ID FROM {s} WHERE snapshot_date >= DATE '1998-01-01'" for s in group)
        + ")"
        for group in _GROUPS
    ),
)
def overlaps(t):
    recent = {name: within(getattr(t, name), "1998-01-01") for name in _SETS}
    return explore.overlaps(recent, _GROUPS)


_LATEST = " ".join(f"arg_max({c}, snapshot_date) AS {c}," for c in ("fe_1", "fe_2", "fe_3", "fe_4"))


@registry.add(
    "latest_known_values",
    out="Customer_ID snapshot_date fe_1:f fe_2:i fe_3:f fe_4:i",
    views="clickstream",
    sql=f"SELECT Customer_ID, {_LATEST} max(snapshot_date) AS snapshot_date FROM clickstream GROUP BY Customer_ID",
)
def latest_known(t):
    return explore.latest_known(t.clickstream)


@registry.add(
    "latest_values_of_all_sources",
    out="""Customer_ID snapshot_date_click snapshot_date_attr snapshot_date_fin fe_1:f fe_2:i fe_3:f fe_4:i
      Age_clean:i Annual_Income_clean:f Credit_History_Months:i""",
    views="clickstream silver_attributes silver_financials",
    sql=f"""SELECT * FROM
      (SELECT Customer_ID, {_LATEST} max(snapshot_date) AS snapshot_date_click FROM clickstream
        WHERE snapshot_date >= DATE '2000-01-01' GROUP BY 1)
      FULL JOIN (SELECT Customer_ID, arg_max(Age_clean, snapshot_date) AS Age_clean,
        max(snapshot_date) AS snapshot_date_attr FROM silver_attributes GROUP BY 1) USING (Customer_ID)
      FULL JOIN (SELECT Customer_ID, arg_max(Annual_Income_clean, snapshot_date) AS Annual_Income_clean,
        arg_max(Credit_History_Months, snapshot_date) AS Credit_History_Months,
        max(snapshot_date) AS snapshot_date_fin FROM silver_financials WHERE snapshot_date >= DATE '1997-01-01'
        GROUP BY 1) USING (Customer_ID)""",
)
def merged(t):
    return explore.merge_latest(
        {
            "click": within(t.clickstream, "2000-01-01"),
            "attr": silver.silver_attributes(t.attributes).select(
                "Customer_ID", "snapshot_date", "Age_clean"
            ),
            "fin": within(silver.silver_financials(t.financials), "1997-01-01").select(
                "Customer_ID", "snapshot_date", "Annual_Income_clean", "Credit_History_Months"
            ),
        }
    )


@registry.add(
    "target_with_complete_features",
    out="Customer_ID Credit_Utilization_Ratio:f click_fe_1:f click_fe_4:f attr_Age_clean:i",
    views="silver_financials silver_clickstream silver_attributes",
    sql="""SELECT f.Customer_ID, Credit_Utilization_Ratio, click_fe_1, click_fe_4, attr_Age_clean FROM silver_financials f
      LEFT JOIN (SELECT Customer_ID, arg_max(fe_1, snapshot_date) AS click_fe_1, arg_max(fe_4, snapshot_date) AS click_fe_4
        FROM silver_clickstream GROUP BY 1) USING (Customer_ID)
      LEFT JOIN (SELECT Customer_ID, arg_max(Age_clean, snapshot_date) AS attr_Age_clean
        FROM silver_attributes GROUP BY 1) USING (Customer_ID)
      WHERE Credit_Utilization_Ratio IS NOT NULL AND click_fe_1 IS NOT NULL AND click_fe_4 IS NOT NULL
        AND attr_Age_clean IS NOT NULL""",
)
def complete(t):
    return explore.complete_with_target(
        silver.silver_financials(t.financials),
        "Credit_Utilization_Ratio",
        {"click": silver.silver_clickstream(t.clickstream), "attr": silver.silver_attributes(t.attributes)},
        ["fe_1", "fe_4", "Age_clean"],
    )


@registry.add(
    "customer_history",
    out="Customer_ID snapshot_date fe_1:f",
    views="clickstream",
    sql="SELECT Customer_ID, snapshot_date, fe_1 FROM clickstream WHERE Customer_ID = '42'",
)
def history(t):
    return explore.customer_history(t.clickstream, "42", "fe_1")


@registry.add(
    "sampled_customers",
    out="Customer_ID",
    views="clickstream",
    sql="""SELECT Customer_ID FROM (SELECT DISTINCT Customer_ID FROM clickstream)
      ORDER BY md5(Customer_ID || '|42'), Customer_ID LIMIT 5""",
)
def sampled(t):
    return explore.sample_keys(t.clickstream, "Customer_ID", 5, seed=42)
