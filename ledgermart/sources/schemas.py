"""Column names and types of the raw sources and of the stores built from them."""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: column names of the raw files
LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}
FINANCIAL_TEXT = [
    "Annual_Income",
    "Num_of_Loan",
    "Num_of_Delayed_Payment",
    "Outstanding_Debt",
]
FINANCIAL_FLOATS = [
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Monthly_Inhand_Salary",
    "Amount_invested_monthly",
    "Monthly_Balance",
]
LABEL_STORE_SCHEMA = "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"

ATTRIBUTE_FEATURES = {
    "Customer_ID": "string",
    "age": "int",
    "age_is_valid": "boolean",
    "occupation": "string",
    "ssn_is_valid": "boolean",
    "attributes_quality_score": "double",
    "age_group": "string",
    "occupation_category": "string",
}
FINANCIAL_FEATURES = {
    "Customer_ID": "string",
    "annual_income": "float",
    "monthly_salary": "float",
    "credit_mix": "string",
    "payment_of_min_amount": "string",
    "credit_history_months": "int",
    "credit_utilization_ratio": "float",
    "delay_from_due_date": "int",
    "num_loans": "float",
    "num_delayed_payments": "float",
    "outstanding_debt": "float",
    "total_emi_monthly": "float",
    "amount_invested_monthly": "float",
    "monthly_balance": "float",
    "debt_to_income_ratio": "double",
    "emi_to_income_ratio": "double",
    "high_credit_utilization": "int",
    "high_debt_burden": "int",
    "payment_issues": "int",
    "financial_health_score": "double",
}
CLICKSTREAM_STATISTICS = ("mean", "std", "min", "max", "cv")


def clickstream_features(columns: list[str]) -> dict[str, str]:
    """Types of the aggregated clickstream features for the given input columns."""
    types = {"Customer_ID": "string"}
    for column in columns:
        for statistic in CLICKSTREAM_STATISTICS:
            types[f"{column}_{statistic}"] = "float" if statistic in ("min", "max") else "double"
    types["clickstream_record_count"] = "bigint"
    types["clickstream_time_span_days"] = "int"
    return types


def ddl(types: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in types.items())


def all_text(columns: list[str]) -> T.StructType:
    """Schema that reads every column of a raw file as text; cleaning casts it later."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
