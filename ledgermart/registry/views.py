"""SQL views that say the same as the sample inputs and the operators' tables.

They are the independent side of the check: written from the rules, not from the Spark plans.
"""

from __future__ import annotations

from ..sources.sample_tables import FIRST_MONTH, LAST_MONTH, MODEL_VERSIONS

_FE = ["fe_1", "fe_2", "fe_3", "fe_4"]

_versions = ", ".join(f"({i}, '{v}')" for i, v in enumerate(MODEL_VERSIONS))

_clickstream_statistics = ",\n  ".join(
    f"avg({c}::DOUBLE) AS {c}_mean, stddev_samp({c}::DOUBLE) AS {c}_std, "
    f"min({c}) AS {c}_min, max({c}) AS {c}_max"
    for c in _FE
)
_clickstream_cv = ",\n  ".join(
    f"CASE WHEN {c}_mean <> 0 THEN {c}_std / abs({c}_mean) ELSE 0 END AS {c}_cv" for c in _FE
)

# name -> (views it needs, text)
VIEWS: dict[str, tuple[str, str]] = {
    "loans": (
        "",
        """
SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, CAST(o_custkey AS VARCHAR) AS Customer_ID,
  start AS loan_start_date, 10 AS tenure, l_linenumber AS installment_num,
  o_totalprice AS loan_amt, due AS due_amt, greatest(due - overdue, 0.0::DOUBLE) AS paid_amt,
  overdue AS overdue_amt, o_totalprice * (1 - l_linenumber / 10.0::DOUBLE) AS balance,
  CAST(start + to_months(l_linenumber) AS DATE) AS snapshot_date
FROM (SELECT *, CASE WHEN flag <> 'R' THEN 0.0::DOUBLE WHEN due = 0 THEN 5.0::DOUBLE
        ELSE due * (CAST(qty AS BIGINT) % 4) END AS overdue
  FROM (SELECT l_orderkey, l_linenumber, flag, qty, o_custkey, o_totalprice,
          CAST(date_trunc('month', o_orderdate) AS DATE) AS start,
          CAST(CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE 100 + (l_orderkey % 9) * 25 END AS DOUBLE) AS due
        FROM (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS flag, max(l_quantity) AS qty
              FROM lineitem GROUP BY l_orderkey, l_linenumber)
        JOIN orders ON o_orderkey = l_orderkey))""",
    ),
    "clickstream": (
        "",
        """
SELECT CAST(o_custkey AS VARCHAR) AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
  sum(l_quantity) AS fe_1, count(*) AS fe_2, max(l_discount) * 100 AS fe_3,
  CASE WHEN o_custkey % 11 <> 0 THEN max(l_linenumber) END AS fe_4
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_custkey, date_trunc('month', o_orderdate)""",
    ),
    "customers": (
        "",
        f"""
SELECT c_custkey AS k, rev, c_acctbal, c_mktsegment,
  CAST(DATE '{FIRST_MONTH}' + to_months(CAST(c_custkey % 60 + rev * 12 AS INTEGER)) AS DATE) AS snapshot_date
FROM customer, (VALUES (0), (1)) AS r(rev) WHERE rev = 0 OR c_custkey % 3 = 0""",
    ),
    "attributes": (
        "customers",
        """
SELECT CAST(k AS VARCHAR) AS Customer_ID,
  CASE WHEN k % 61 = 0 THEN NULL WHEN k % 50 = 7 THEN '-500'
       WHEN k % 20 = 0 THEN CAST(18 + k % 73 + rev AS VARCHAR) || '_'
       ELSE CAST(18 + k % 73 + rev AS VARCHAR) END AS Age,
  CASE WHEN k % 18 = 0 THEN '#F%$D@*&8'
       ELSE lpad(CAST(k % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(k % 100 AS VARCHAR), 2, '0')
            || '-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') END AS SSN,
  CASE WHEN (k + rev) % 14 = 0 THEN '_______' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Mechanic'
       WHEN c_mktsegment = 'BUILDING' THEN 'Architect' WHEN c_mktsegment = 'FURNITURE' THEN 'Teacher'
       WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Writer' WHEN c_mktsegment = 'MACHINERY' THEN 'Developer'
       END AS Occupation, snapshot_date
FROM customers""",
    ),
    "financials": (
        "customers",
        """
SELECT CAST(k AS VARCHAR) AS Customer_ID,
  CASE WHEN k % 83 = 0 THEN '0' WHEN k % 19 = 0 THEN CAST(a * 10 AS VARCHAR) || '_'
       ELSE CAST(a * 10 AS VARCHAR) END AS Annual_Income,
  CAST(CASE WHEN k % 37 = 0 THEN 0 ELSE a END AS DOUBLE) AS Monthly_Inhand_Salary,
  CASE WHEN k % 41 = 0 THEN '-100' ELSE CAST(coalesce(n, 0) % 10 AS VARCHAR) END AS Num_of_Loan,
  CASE WHEN k % 23 = 0 THEN CAST(k % 25 AS VARCHAR) || '_' ELSE CAST(k % 25 AS VARCHAR) END AS Num_of_Delayed_Payment,
  CAST((a * 7) % 5000 AS VARCHAR) AS Outstanding_Debt,
  CASE k % 4 WHEN 0 THEN 'Good' WHEN 1 THEN 'Standard' WHEN 2 THEN 'Bad' ELSE '_' END AS Credit_Mix,
  CASE k % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END AS Payment_of_Min_Amount,
  CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN CAST(k % 12 AS VARCHAR) || ' Months'
       ELSE CAST(k % 30 AS VARCHAR) || ' Years and ' || CAST(k % 12 AS VARCHAR) || ' Months' END AS Credit_History_Age,
  20 + (k % 300) / 10.0::DOUBLE AS Credit_Utilization_Ratio,
  CAST(k % 60 AS INTEGER) AS Delay_from_due_date, CAST(k % 500 AS DOUBLE) AS Total_EMI_per_month,
  CAST(k % 700 AS DOUBLE) AS Amount_invested_monthly, CAST(k % 900 AS DOUBLE) AS Monthly_Balance,
  CASE k % 7 WHEN 0 THEN '' WHEN 1 THEN '_' WHEN 2 THEN ' ' || upper(c_mktsegment) || ' '
       WHEN 3 THEN 'Not Specified' WHEN 4 THEN NULL WHEN 5 THEN 'home-equity loan'
       ELSE lower(c_mktsegment) || ' loan' END AS Type_of_Loan, snapshot_date
FROM (SELECT *, CAST(floor(abs(c_acctbal)) AS BIGINT) + rev * 100 AS a FROM customers)
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = k""",
    ),
    "predictions": (
        "loans",
        f"""
SELECT Customer_ID, loan_id, snapshot_date AS feature_snapshot_date,
  CAST(snapshot_date AS VARCHAR) AS snapshot_date, model_version, p AS model_prediction_proba,
  CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS model_prediction_binary
FROM (SELECT l.*, v.model_version,
        ((CAST(loan_id AS BIGINT) * 7919 + v.i * 31) % 10007) / CAST(10006 AS DOUBLE) AS p
      FROM loans l, (VALUES {_versions}) AS v(i, model_version) WHERE installment_num = 6)""",
    ),
    "silver_loans": (
        "loans",
        """
SELECT * EXCLUDE (first_missed), first_missed AS first_missed_date,
  CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed, snapshot_date) ELSE 0 END AS dpd
FROM (SELECT *, CASE WHEN installments_missed > 0
        THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed
  FROM (SELECT loan_id, Customer_ID, loan_start_date, tenure, installment_num,
      loan_amt::FLOAT AS loan_amt, due_amt::FLOAT AS due_amt, paid_amt::FLOAT AS paid_amt,
      overdue_amt::FLOAT AS overdue_amt, balance::FLOAT AS balance, snapshot_date,
      installment_num AS mob,
      coalesce(CAST(ceil(overdue_amt::FLOAT::DOUBLE / nullif(due_amt::FLOAT::DOUBLE, 0)) AS INTEGER), 0)
        AS installments_missed
    FROM loans))""",
    ),
    "label_store": (
        "silver_loans",
        """
SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
  '30dpd_6mob' AS label_def, snapshot_date FROM silver_loans WHERE mob = 6""",
    ),
    "silver_clickstream": (
        "clickstream",
        f"""
SELECT Customer_ID, snapshot_date, {", ".join(f"{c}::FLOAT AS {c}" for c in _FE)},
  ({" OR ".join(f"{c} IS NULL" for c in _FE)}) AS has_null_features, {len(_FE)} AS feature_count
FROM clickstream""",
    ),
    "silver_attributes": (
        "attributes",
        r"""
SELECT *, (CASE WHEN Age_valid THEN 1 ELSE 0 END + CASE WHEN SSN_valid THEN 1 ELSE 0 END
    + CASE WHEN Occupation_clean <> 'Unknown' THEN 1 ELSE 0 END) / 3.0::DOUBLE AS data_quality_score
FROM (SELECT *, coalesce(Age_clean BETWEEN 18 AND 90, false) AS Age_valid,
        CASE WHEN regexp_full_match(Occupation, '_+') THEN 'Unknown' ELSE Occupation END AS Occupation_clean,
        coalesce(regexp_full_match(SSN, '[0-9\-]+'), false) AS SSN_valid
      FROM (SELECT *, CAST(trunc(TRY_CAST(replace(Age, '_', '') AS DOUBLE)) AS INTEGER) AS Age_clean
            FROM attributes))""",
    ),
    "silver_financials": (
        "financials",
        r"""
SELECT *, CASE WHEN Annual_Income_clean > 0
    THEN Outstanding_Debt_clean::DOUBLE / Annual_Income_clean::DOUBLE END AS debt_to_income_ratio,
  CASE WHEN Monthly_Inhand_Salary > 0
    THEN Total_EMI_per_month::DOUBLE / Monthly_Inhand_Salary::DOUBLE END AS emi_to_income_ratio
FROM (SELECT Customer_ID, snapshot_date, Type_of_Loan, Credit_Mix, Payment_of_Min_Amount, Credit_History_Age,
    Annual_Income, Num_of_Loan, Num_of_Delayed_Payment, Outstanding_Debt,
    TRY_CAST(replace(Annual_Income, '_', '') AS FLOAT) AS Annual_Income_clean,
    TRY_CAST(replace(Num_of_Loan, '_', '') AS FLOAT) AS Num_of_Loan_clean,
    TRY_CAST(replace(Num_of_Delayed_Payment, '_', '') AS FLOAT) AS Num_of_Delayed_Payment_clean,
    TRY_CAST(replace(Outstanding_Debt, '_', '') AS FLOAT) AS Outstanding_Debt_clean,
    CASE WHEN Credit_Mix = '_' THEN 'Unknown' ELSE Credit_Mix END AS Credit_Mix_clean,
    CASE WHEN Payment_of_Min_Amount = 'NM' THEN 'No' ELSE Payment_of_Min_Amount END AS Payment_of_Min_Amount_clean,
    TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Years?', 1) AS INTEGER) * 12
      + coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s*Months?', 1) AS INTEGER), 0) AS Credit_History_Months,
    Credit_Utilization_Ratio::FLOAT AS Credit_Utilization_Ratio, Delay_from_due_date,
    Total_EMI_per_month::FLOAT AS Total_EMI_per_month, Monthly_Inhand_Salary::FLOAT AS Monthly_Inhand_Salary,
    Amount_invested_monthly::FLOAT AS Amount_invested_monthly, Monthly_Balance::FLOAT AS Monthly_Balance
  FROM financials)""",
    ),
    "snapshots": (
        "",
        f"""
SELECT CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(
  DATE '{FIRST_MONTH}' + INTERVAL 6 MONTH, TIMESTAMP '{LAST_MONTH}', INTERVAL 1 MONTH)) AS d)""",
    ),
    "clickstream_seen": (
        "snapshots silver_clickstream",
        """
SELECT d, c.* FROM snapshots JOIN silver_clickstream c
  ON c.snapshot_date BETWEEN CAST(d - INTERVAL 6 MONTH AS DATE) AND d""",
    ),
    "clickstream_features": (
        "clickstream_seen",
        f"""
SELECT *, {_clickstream_cv} FROM (
SELECT d, Customer_ID, {_clickstream_statistics},
  count(*) AS clickstream_record_count,
  date_diff('day', min(snapshot_date), max(snapshot_date)) AS clickstream_time_span_days
FROM clickstream_seen GROUP BY d, Customer_ID)""",
    ),
    "attributes_seen": (
        "snapshots silver_attributes",
        "SELECT d, a.* FROM snapshots JOIN silver_attributes a ON a.snapshot_date <= d",
    ),
    "attribute_features": (
        "attributes_seen",
        """
SELECT d, Customer_ID, Age_clean AS age, Age_valid AS age_is_valid, Occupation_clean AS occupation,
  SSN_valid AS ssn_is_valid, data_quality_score AS attributes_quality_score,
  CASE WHEN Age_clean >= 18 AND Age_clean < 30 THEN '18-29' WHEN Age_clean >= 30 AND Age_clean < 40 THEN '30-39'
       WHEN Age_clean >= 40 AND Age_clean < 50 THEN '40-49' WHEN Age_clean >= 50 AND Age_clean < 60 THEN '50-59'
       WHEN Age_clean >= 60 THEN '60+' ELSE 'Unknown' END AS age_group,
  CASE WHEN Occupation_clean IN ('Lawyer', 'Doctor', 'Architect', 'Engineer') THEN 'Professional'
       WHEN Occupation_clean IN ('Teacher', 'Scientist') THEN 'Education_Research'
       WHEN Occupation_clean IN ('Developer', 'Media_Manager') THEN 'Technology_Media'
       WHEN Occupation_clean IN ('Mechanic', 'Accountant') THEN 'Technical_Services'
       WHEN Occupation_clean = 'Unknown' THEN 'Unknown' ELSE 'Other' END AS occupation_category
FROM (SELECT *, row_number() OVER (PARTITION BY d, Customer_ID ORDER BY snapshot_date DESC) AS rn
      FROM attributes_seen) WHERE rn = 1""",
    ),
    "financials_seen": (
        "snapshots silver_financials",
        "SELECT d, f.* FROM snapshots JOIN silver_financials f ON f.snapshot_date <= d",
    ),
    "financial_features": (
        "financials_seen",
        """
SELECT *, ((CASE WHEN credit_mix = 'Good' THEN 1 ELSE 0 END)
    + (CASE WHEN payment_of_min_amount = 'Yes' THEN 1 ELSE 0 END) + (1 - high_credit_utilization)
    + (1 - high_debt_burden) + (1 - payment_issues)) / 5.0::DOUBLE AS financial_health_score
FROM (SELECT *, CASE WHEN credit_utilization_ratio > 30 THEN 1 ELSE 0 END AS high_credit_utilization,
    CASE WHEN debt_to_income_ratio > 0.4::DOUBLE THEN 1 ELSE 0 END AS high_debt_burden,
    CASE WHEN num_delayed_payments > 5 OR delay_from_due_date > 30 THEN 1 ELSE 0 END AS payment_issues
  FROM (SELECT d, Customer_ID, Annual_Income_clean AS annual_income, Monthly_Inhand_Salary AS monthly_salary,
      Credit_Mix_clean AS credit_mix, Payment_of_Min_Amount_clean AS payment_of_min_amount,
      Credit_History_Months AS credit_history_months, Credit_Utilization_Ratio AS credit_utilization_ratio,
      Delay_from_due_date AS delay_from_due_date, Num_of_Loan_clean AS num_loans,
      Num_of_Delayed_Payment_clean AS num_delayed_payments, Outstanding_Debt_clean AS outstanding_debt,
      Total_EMI_per_month AS total_emi_monthly, Amount_invested_monthly AS amount_invested_monthly,
      Monthly_Balance AS monthly_balance, debt_to_income_ratio, emi_to_income_ratio
    FROM (SELECT *, row_number() OVER (PARTITION BY d, Customer_ID ORDER BY snapshot_date DESC) AS rn
          FROM financials_seen) WHERE rn = 1))""",
    ),
    "universe": (
        "clickstream_seen attributes_seen financials_seen",
        """
SELECT d, Customer_ID FROM clickstream_seen UNION SELECT d, Customer_ID FROM attributes_seen
UNION SELECT d, Customer_ID FROM financials_seen""",
    ),
    "feature_store": (
        "universe clickstream_features attribute_features financial_features",
        """
SELECT *, (has_clickstream_data + has_attributes_data + has_financial_data) / 3.0::DOUBLE AS data_completeness_score
FROM (SELECT u.Customer_ID, u.d AS feature_snapshot_date,
    f.* EXCLUDE (d, Customer_ID), a.* EXCLUDE (d, Customer_ID), c.* EXCLUDE (d, Customer_ID),
    (age::FLOAT * annual_income)::DOUBLE / 1000000 AS age_income_interaction,
    CASE WHEN age > 0 THEN credit_history_months::DOUBLE / age END AS relative_credit_history,
    CASE WHEN debt_to_income_ratio IS NOT NULL AND age > 0 THEN debt_to_income_ratio * (age / 40.0::DOUBLE)
         ELSE debt_to_income_ratio END AS age_adjusted_debt_ratio,
    CASE WHEN clickstream_record_count IS NULL THEN 0 ELSE 1 END AS has_clickstream_data,
    CASE WHEN age IS NULL THEN 0 ELSE 1 END AS has_attributes_data,
    CASE WHEN annual_income IS NULL THEN 0 ELSE 1 END AS has_financial_data
  FROM universe u LEFT JOIN financial_features f USING (d, Customer_ID)
    LEFT JOIN attribute_features a USING (d, Customer_ID)
    LEFT JOIN clickstream_features c USING (d, Customer_ID))""",
    ),
    "training": (
        "label_store feature_store",
        """
SELECT l.*, f.* EXCLUDE (Customer_ID, feature_snapshot_date) FROM label_store l LEFT JOIN feature_store f
  ON f.Customer_ID = l.Customer_ID AND f.feature_snapshot_date = l.snapshot_date
WHERE l.snapshot_date BETWEEN DATE '1997-11-01' AND DATE '1998-12-31'""",
    ),
    "split_rows": (
        "training",
        """
SELECT *, CASE WHEN snapshot_date >= DATE '1998-11-01' THEN 'oot'
    WHEN place <= n - ceil((1 - 0.8::DOUBLE) * n) THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY snapshot_date, loan_id) AS place,
        count(*) FILTER (snapshot_date < DATE '1998-11-01') OVER () AS n FROM training)""",
    ),
    "train": ("split_rows", "SELECT * FROM split_rows WHERE split = 'train'"),
    "first_labels": (
        "label_store",
        """
SELECT Customer_ID, label AS actual_label FROM (SELECT *, row_number() OVER (
    PARTITION BY Customer_ID ORDER BY snapshot_date, loan_id) AS rn FROM label_store) WHERE rn = 1""",
    ),
    "monitored": (
        "predictions first_labels",
        """
SELECT p.* REPLACE (CAST(p.snapshot_date AS DATE) AS snapshot_date), actual_label
FROM predictions p JOIN first_labels USING (Customer_ID)""",
    ),
}


def with_views(sql: str, names: list[str]) -> str:
    """The text preceded by the views it needs, each after the ones it is built on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in VIEWS[name][0].split():
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return sql.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name][1].strip()})" for name in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
