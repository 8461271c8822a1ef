"""Point-in-time feature queries."""

from pyspark.sql import functions as F

from ..operators import features as f
from ..operators import silver
from ..sources.sample_tables import LAST_MONTH
from ..sources.schemas import FINANCIAL_FEATURES
from .check import Registry

registry = Registry()

DAY = "1999-06-01"
FIRST_SNAPSHOT = "1995-07-01"
_STATISTICS = " ".join(
    f"fe_{k}_{s}:f" for k in (1, 2, 3, 4) for s in ("mean", "std", "min", "max", "cv")
)
_CLICKS = _STATISTICS + " clickstream_record_count:i clickstream_time_span_days:i"
_ATTRIBUTES = (
    "age:i age_is_valid occupation ssn_is_valid attributes_quality_score:f age_group occupation_category"
)
_SUFFIX = {"string": "", "int": ":i", "float": ":f", "double": ":f"}
_FINANCES = " ".join(
    name + _SUFFIX[kind] for name, kind in FINANCIAL_FEATURES.items() if name != "Customer_ID"
)
_DERIVED = """age_income_interaction:f relative_credit_history:f age_adjusted_debt_ratio:f
  has_clickstream_data:i has_attributes_data:i has_financial_data:i data_completeness_score:f"""
_STORE = f"Customer_ID feature_snapshot_date {_FINANCES} {_ATTRIBUTES} {_CLICKS} {_DERIVED}"


def silver_sources(t):
    return (
        silver.silver_clickstream(t.clickstream),
        silver.silver_attributes(t.attributes),
        silver.silver_financials(t.financials),
    )


def full_store(t):
    return f.feature_store_backfill(*silver_sources(t), FIRST_SNAPSHOT, LAST_MONTH)


@registry.add(
    "lookback_slice",
    out="Customer_ID snapshot_date fe_1:f",
    views="silver_clickstream",
    sql=f"""SELECT Customer_ID, snapshot_date, fe_1 FROM silver_clickstream
      WHERE snapshot_date BETWEEN DATE '{DAY}' - INTERVAL 6 MONTH AND DATE '{DAY}'""",
)
def lookback(t):
    return f.lookback_slice(silver_sources(t)[0], DAY).select("Customer_ID", "snapshot_date", "fe_1")


@registry.add(
    "as_of_slice",
    out="Customer_ID file_date Age_clean:i",
    views="silver_attributes",
    sql=f"""SELECT Customer_ID, snapshot_date AS file_date, Age_clean FROM silver_attributes
      WHERE snapshot_date <= DATE '{DAY}'""",
)
def as_of(t):
    return f.as_of_slice(silver_sources(t)[1], DAY).select("Customer_ID", "file_date", "Age_clean")


@registry.add(
    "clickstream_aggregates",
    out="Customer_ID " + _CLICKS,
    views="clickstream_features",
    sql=f"SELECT * FROM clickstream_features WHERE d = DATE '{DAY}'",
)
def clickstream_aggregates(t):
    return f.clickstream_aggregates(f.lookback_slice(silver_sources(t)[0], DAY))


@registry.add(
    "clickstream_aggregates_all_snapshots",
    out="Customer_ID snapshot " + _CLICKS,
    views="clickstream_features",
    sql="SELECT d AS snapshot, * EXCLUDE (d) FROM clickstream_features",
)
def clickstream_all(t):
    return f.clickstream_backfill(silver_sources(t)[0], FIRST_SNAPSHOT, LAST_MONTH)


@registry.add(
    "latest_attributes_as_of",
    out="Customer_ID snapshot_date Age_clean:i Occupation_clean",
    views="silver_attributes",
    sql=f"""SELECT * FROM silver_attributes WHERE snapshot_date <= DATE '{DAY}'
      QUALIFY row_number() OVER (PARTITION BY Customer_ID ORDER BY snapshot_date DESC) = 1""",
)
def latest_attributes(t):
    known = f.as_of_slice(silver_sources(t)[1], DAY)
    return f.latest_record(known, date="file_date").select(
        "Customer_ID", "snapshot_date", "Age_clean", "Occupation_clean"
    )


@registry.add(
    "attribute_features",
    out="Customer_ID " + _ATTRIBUTES,
    views="attribute_features",
    sql=f"SELECT * FROM attribute_features WHERE d = DATE '{DAY}'",
)
def attribute_features(t):
    known = f.as_of_slice(silver_sources(t)[1], DAY)
    return f.attribute_features(f.latest_record(known, date="file_date"))


@registry.add(
    "age_groups",
    out="age_group customers:i",
    views="attribute_features",
    sql=f"SELECT age_group, count(*) AS customers FROM attribute_features WHERE d = DATE '{LAST_MONTH}' GROUP BY 1",
)
def age_groups(t):
    return attribute_shares(t, "age_group")


@registry.add(
    "occupation_categories",
    out="occupation_category customers:i",
    views="attribute_features",
    sql=f"""SELECT occupation_category, count(*) AS customers FROM attribute_features
      WHERE d = DATE '{LAST_MONTH}' GROUP BY 1""",
)
def occupation_categories(t):
    return attribute_shares(t, "occupation_category")


def attribute_shares(t, column):
    known = f.as_of_slice(silver_sources(t)[1], LAST_MONTH)
    features = f.attribute_features(f.latest_record(known, date="file_date"))
    return features.groupBy(column).agg(F.count("*").alias("customers"))


@registry.add(
    "financial_features",
    out="Customer_ID " + _FINANCES,
    views="financial_features",
    sql=f"SELECT * FROM financial_features WHERE d = DATE '{DAY}'",
)
def financial_features(t):
    known = f.as_of_slice(silver_sources(t)[2], DAY)
    return f.financial_features(f.latest_record(known, date="file_date"))


@registry.add(
    "risk_flags_and_health",
    out="high_credit_utilization:i high_debt_burden:i payment_issues:i customers:i health:f",
    views="financial_features",
    sql=f"""SELECT high_credit_utilization, high_debt_burden, payment_issues, count(*) AS customers,
      avg(financial_health_score) AS health FROM financial_features WHERE d = DATE '{LAST_MONTH}' GROUP BY 1, 2, 3""",
)
def risk_flags(t):
    known = f.as_of_slice(silver_sources(t)[2], LAST_MONTH)
    flags = ["high_credit_utilization", "high_debt_burden", "payment_issues"]
    return (
        f.financial_features(f.latest_record(known, date="file_date"))
        .groupBy(*flags)
        .agg(F.count("*").alias("customers"), F.avg("financial_health_score").alias("health"))
    )


@registry.add(
    "customer_universe",
    out="Customer_ID",
    views="universe",
    sql=f"SELECT Customer_ID FROM universe WHERE d = DATE '{FIRST_SNAPSHOT}'",
)
def universe(t):
    clicks, people, money = silver_sources(t)
    return f.customer_universe(
        f.lookback_slice(clicks, FIRST_SNAPSHOT),
        f.as_of_slice(people, FIRST_SNAPSHOT),
        f.as_of_slice(money, FIRST_SNAPSHOT),
    )


@registry.add(
    "customer_universe_all_snapshots",
    out="Customer_ID snapshot",
    views="universe",
    sql="SELECT d AS snapshot, Customer_ID FROM universe",
)
def universe_all(t):
    return f.universe_backfill(*silver_sources(t), FIRST_SNAPSHOT, LAST_MONTH)


@registry.add(
    "customer_centric_join",
    out=f"Customer_ID feature_snapshot_date {_FINANCES} {_ATTRIBUTES} {_CLICKS}",
    views="feature_store",
    sql=f"SELECT * FROM feature_store WHERE feature_snapshot_date = DATE '{FIRST_SNAPSHOT}'",
)
def centric_join(t):
    clicks, people, money = silver_sources(t)
    recent = f.lookback_slice(clicks, FIRST_SNAPSHOT)
    people, money = f.as_of_slice(people, FIRST_SNAPSHOT), f.as_of_slice(money, FIRST_SNAPSHOT)
    return f.combine_customer_centric(
        f.customer_universe(recent, people, money),
        f.financial_features(f.latest_record(money)),
        f.attribute_features(f.latest_record(people)),
        f.clickstream_aggregates(recent),
        FIRST_SNAPSHOT,
    )


@registry.add(
    "feature_store_one_snapshot",
    out=_STORE,
    views="feature_store",
    sql=f"SELECT * FROM feature_store WHERE feature_snapshot_date = DATE '{DAY}'",
)
def one_snapshot(t):
    return f.feature_store(*silver_sources(t), DAY)


@registry.add(
    "feature_store_without_clickstream",
    out=_STORE,
    views="feature_store",
    sql=f"""SELECT * REPLACE ({", ".join(f"NULL AS {c.split(':')[0]}" for c in _CLICKS.split())},
        0 AS has_clickstream_data, (has_attributes_data + has_financial_data) / 3.0::DOUBLE AS data_completeness_score)
      FROM feature_store WHERE feature_snapshot_date = DATE '{DAY}'
      AND (has_attributes_data = 1 OR has_financial_data = 1 OR age_is_valid IS NOT NULL)""",
)
def without_clickstream(t):
    clicks, people, money = silver_sources(t)
    nothing = t.spark.createDataFrame([], clicks.schema)
    return f.feature_store(nothing, people, money, DAY)


@registry.add(
    "feature_store_all_snapshots", out=_STORE, views="feature_store", sql="SELECT * FROM feature_store"
)
def all_snapshots(t):
    return full_store(t)


@registry.add(
    "interaction_features",
    out="feature_snapshot_date rows:i age_income:f history:f debt:f",
    views="feature_store",
    sql="""SELECT feature_snapshot_date, count(*) AS rows, avg(age_income_interaction) AS age_income,
      avg(relative_credit_history) AS history, avg(age_adjusted_debt_ratio) AS debt
      FROM feature_store GROUP BY 1""",
)
def interactions(t):
    return (
        full_store(t)
        .groupBy("feature_snapshot_date")
        .agg(
            F.count("*").alias("rows"),
            F.avg("age_income_interaction").alias("age_income"),
            F.avg("relative_credit_history").alias("history"),
            F.avg("age_adjusted_debt_ratio").alias("debt"),
        )
    )


@registry.add(
    "availability_flags",
    out="has_clickstream_data:i has_attributes_data:i has_financial_data:i rows:i completeness:f",
    views="feature_store",
    sql="""SELECT has_clickstream_data, has_attributes_data, has_financial_data, count(*) AS rows,
      avg(data_completeness_score) AS completeness FROM feature_store GROUP BY 1, 2, 3""",
)
def availability(t):
    flags = ["has_clickstream_data", "has_attributes_data", "has_financial_data"]
    return full_store(t).groupBy(*flags).agg(
        F.count("*").alias("rows"), F.avg("data_completeness_score").alias("completeness")
    )
