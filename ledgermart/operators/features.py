"""Point-in-time feature store: one row per customer and feature snapshot.

``feature_store`` builds one snapshot, ``feature_store_backfill`` any number of them in one job.
The backfill first reduces every source to at most one row per customer and date, moves these rows
by customer, and only then spreads them over the snapshots they serve: the many rows per customer
and snapshot are made, aggregated and joined where they are and never cross the network.  They are
many times the rows that were moved, so their number, not the size of the shuffle, sets the number
of tasks, and the joins build their tables per task: none is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import (
    band,
    exclude,
    indicator,
    month_start,
    ratio_if_positive,
    with_prefix,
)
from ..sources.schemas import (
    ATTRIBUTE_FEATURES,
    CLICKSTREAM_STATISTICS,
    FINANCIAL_FEATURES,
    clickstream_features,
    ddl,
)

# fixed values: occupation groups
OCCUPATION_GROUPS = {
    "Professional": ["Lawyer", "Doctor", "Architect", "Engineer"],
    "Education_Research": ["Teacher", "Scientist"],
    "Technology_Media": ["Developer", "Media_Manager"],
    "Technical_Services": ["Mechanic", "Accountant"],
    "Unknown": ["Unknown"],
}
AGE_EDGES = [18, 30, 40, 50, 60, float("inf")]
AGE_LABELS = ["18-29", "30-39", "40-49", "50-59", "60+"]

#: rows of (customer, snapshot) that one task of a backfill holds at most, about
ROWS_PER_TASK = 250_000


# --- records that a snapshot may see --------------------------------------------------------


def lookback_slice(df: DataFrame, day: str, months: int = 6) -> DataFrame:
    """Records from ``months`` before the snapshot up to it, both ends included."""
    snapshot = F.lit(day).cast("date")
    return df.where(F.col("snapshot_date").between(F.add_months(snapshot, -months), snapshot))


def as_of_slice(df: DataFrame, day: str) -> DataFrame:
    """Records dated up to the snapshot, carrying their own date as ``file_date``."""
    return df.where(F.col("snapshot_date") <= F.lit(day).cast("date")).withColumn(
        "file_date", F.col("snapshot_date")
    )


def _first_snapshot(day: Column) -> Column:
    """The first-of-month date on or after a day."""
    return F.when(day == month_start(day), day).otherwise(F.add_months(month_start(day), 1))


def _snapshots(first: Column, last: Column, start: str, end: str) -> Column:
    """First-of-month dates in [first, last] and [start, end]; no dates when one is missing."""
    low = F.greatest(_first_snapshot(first), F.lit(start).cast("date"))
    high = F.least(last, F.lit(end).cast("date"))
    months = F.sequence(low, high, F.expr("interval 1 month"))
    known = first.isNotNull() & last.isNotNull() & (low <= high)
    return F.when(known, months).otherwise(F.array().cast("array<date>"))


def _lookback_snapshots(day: Column, start: str, end: str, months: int) -> Column:
    """The snapshots whose lookback includes a day."""
    return _snapshots(day, month_start(F.add_months(day, months)), start, end)


def backfill_partitions(start: str, end: str, *sources: DataFrame) -> int:
    """Number of tasks for the rows of all customers of the sources at the snapshots from ``start`` to ``end``."""
    ids = [source.select("Customer_ID") for source in sources]
    every = ids[0]
    for more in ids[1:]:
        every = every.union(more)
    snapshots = F.ceil(F.months_between(F.lit(end).cast("date"), F.lit(start).cast("date"))) + 1
    rows = F.approx_count_distinct("Customer_ID") * F.greatest(snapshots, F.lit(1))
    # rows in a single partition do not count as distributed by customer: they would be moved again
    return max(2, math.ceil(every.agg(rows).first()[0] / ROWS_PER_TASK))


# --- behaviour -------------------------------------------------------------------------------


def clickstream_aggregates(
    df: DataFrame, keys: Sequence[str] = ("Customer_ID",), prefix: str = "fe_"
) -> DataFrame:
    """Mean, sample deviation, minimum, maximum and variation of every feature per group.

    Also the number of records and the days between the first and the last one.
    """
    features = with_prefix(df.columns, prefix)
    statistics = []
    for name in features:
        c = F.col(name)
        statistics += [
            F.avg(c).alias(f"{name}_mean"),
            F.stddev_samp(c).alias(f"{name}_std"),
            F.min(c).alias(f"{name}_min"),
            F.max(c).alias(f"{name}_max"),
        ]
    grouped = df.groupBy(*keys).agg(
        *statistics,
        F.count("*").alias("clickstream_record_count"),
        F.datediff(F.max("snapshot_date"), F.min("snapshot_date")).alias("clickstream_time_span_days"),
    )
    return grouped.withColumns({f"{name}_cv": variation(name) for name in features})


def variation(name: str) -> Column:
    """Deviation over absolute mean; 0 for a zero or missing mean."""
    mean = F.col(f"{name}_mean")
    return F.when(mean != 0, F.col(f"{name}_std") / F.abs(mean)).otherwise(0.0)


def lookback_span(df: DataFrame, start: str, end: str, months: int) -> DataFrame:
    """Records that any snapshot from ``start`` to ``end`` can see in its lookback."""
    earliest = F.add_months(month_start(F.lit(start).cast("date")), -months)
    return df.where(F.col("snapshot_date").between(earliest, F.lit(end).cast("date")))


def clickstream_backfill(
    df: DataFrame,
    start: str,
    end: str,
    months: int = 6,
    prefix: str = "fe_",
    partitions: int | None = None,
    universe: DataFrame | None = None,
) -> DataFrame:
    """``clickstream_aggregates`` of every customer and monthly snapshot.

    Records move once, by customer, as they are: a record is a fifth of its partial sums, and the
    frame of a customer then needs no further exchange.  ``partitions`` (counted unless given) keeps
    the sums that a task holds from growing with the input.  Records are reduced to counts, sums and
    squared deviations per customer and date, which are spread over and pooled per snapshot where
    they are; deviations are taken from the customer's overall mean, which keeps the pooled
    variance accurate.  (The same sums as sliding range frames take twice as long: each of 120
    frames is added up again for every row, and the rows have to be sorted.)

    With a ``universe`` (customers and snapshots, distributed by customer over as many partitions)
    the result has exactly its rows, all NULL where nothing was recorded: its rows are pooled as records that
    count for nothing, which takes no join.
    """
    features = with_prefix(df.columns, prefix)
    per_date = []
    for name in features:
        c = F.col(name).cast("double")
        per_date += [
            F.count(c).alias(f"{name}_n"),
            F.sum(c).alias(f"{name}_sum"),
            (F.var_pop(c) * F.count(c)).alias(f"{name}_squares"),
            F.min(name).alias(f"{name}_low"),
            F.max(name).alias(f"{name}_high"),
        ]
    recent = lookback_span(df, start, end, months)
    daily = (
        recent.repartition(partitions or backfill_partitions(start, end, recent), "Customer_ID")
        .groupBy("Customer_ID", "snapshot_date")
        .agg(F.count("*").alias("_records"), *per_date)
    )
    customer = W.partitionBy("Customer_ID")
    centred = daily.withColumns(
        {
            f"{name}_off": F.try_divide(f"{name}_sum", f"{name}_n")
            - F.try_divide(F.sum(f"{name}_sum").over(customer), F.sum(f"{name}_n").over(customer))
            for name in features
        }
    )
    served = _lookback_snapshots(F.col("snapshot_date"), start, end, months)
    spread = centred.withColumn("snapshot", F.explode(served))
    if universe is not None:
        # a missing customer is no key: as in a join, its records belong to no row
        spread = spread.where(F.col("Customer_ID").isNotNull()).unionByName(universe, allowMissingColumns=True)
    pooled = []
    for name in features:
        n, off = F.col(f"{name}_n"), F.col(f"{name}_off")
        pooled += [
            F.sum(n).alias(f"{name}_n"),
            F.sum(f"{name}_sum").alias(f"{name}_sum"),
            F.sum(n * off).alias(f"{name}_off"),
            F.sum(F.col(f"{name}_squares") + n * off * off).alias(f"{name}_squares"),
            F.min(f"{name}_low").alias(f"{name}_min"),
            F.max(f"{name}_high").alias(f"{name}_max"),
        ]
    grouped = spread.groupBy("Customer_ID", "snapshot").agg(
        *pooled,
        F.sum("_records").alias("clickstream_record_count"),
        F.datediff(F.max("snapshot_date"), F.min("snapshot_date")).alias("clickstream_time_span_days"),
    )
    moments = {}
    for name in features:
        n, off = F.col(f"{name}_n"), F.col(f"{name}_off")
        spread_squares = F.greatest(F.col(f"{name}_squares") - off * off / n, F.lit(0.0))
        moments[f"{name}_mean"] = F.try_divide(f"{name}_sum", f"{name}_n")
        moments[f"{name}_std"] = F.when(
            n > 1,
            F.when(F.col(f"{name}_min") == F.col(f"{name}_max"), 0.0).otherwise(
                F.sqrt(spread_squares / (n - 1))
            ),
        )
    measured = grouped.withColumns(moments)
    measured = measured.withColumns({f"{name}_cv": variation(name) for name in features})
    if universe is not None:
        recorded = F.col("clickstream_record_count").isNotNull()
        measured = measured.withColumns({f"{name}_cv": F.when(recorded, F.col(f"{name}_cv")) for name in features})
    return measured.select(
        "Customer_ID",
        "snapshot",
        *[f"{name}_{kind}" for name in features for kind in CLICKSTREAM_STATISTICS],
        "clickstream_record_count",
        "clickstream_time_span_days",
    )


# --- latest records --------------------------------------------------------------------------


def latest_record(
    df: DataFrame, keys: Sequence[str] = ("Customer_ID",), date: str = "snapshot_date"
) -> DataFrame:
    """The newest record per key; among records of one date the choice is fixed by their hash."""
    rest = exclude(df.columns, *keys, date)
    newest = W.partitionBy(*keys).orderBy(F.col(date).desc(), F.xxhash64(*rest), *rest)
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def latest_backfill(df: DataFrame, start: str, end: str, partitions: int | None = None) -> DataFrame:
    """The record that is the newest one at each monthly snapshot, per customer.

    Only one record per customer and date can ever be the newest; each serves the snapshots from
    its date to the day before the customer's next record, given as ``_from`` and ``_until``.
    """
    known = df.where(F.col("snapshot_date") <= F.lit(end).cast("date"))
    spread = known.repartition(partitions or backfill_partitions(start, end, known), "Customer_ID")
    per_date = latest_record(spread, ("Customer_ID", "snapshot_date"))
    following = F.lead("snapshot_date").over(W.partitionBy("Customer_ID").orderBy("snapshot_date"))
    until = F.coalesce(F.date_sub(following, 1), F.lit(end).cast("date"))
    return per_date.withColumn("_from", F.col("snapshot_date")).withColumn("_until", until)


# --- demographic and financial features -------------------------------------------------------


def age_group(age: Column) -> Column:
    return F.coalesce(band(age, AGE_EDGES, AGE_LABELS, closed="left"), F.lit("Unknown"))


def occupation_category(occupation: Column) -> Column:
    result = None
    for group, members in OCCUPATION_GROUPS.items():
        member = occupation.isin(members)
        result = F.when(member, group) if result is None else result.when(member, group)
    return result.otherwise("Other")


def attribute_features(latest: DataFrame, *carried: str) -> DataFrame:
    """Model-facing names of the demographic columns with age and occupation groups."""
    return latest.select(
        "Customer_ID",
        *carried,
        F.col("Age_clean").alias("age"),
        F.col("Age_valid").alias("age_is_valid"),
        F.col("Occupation_clean").alias("occupation"),
        F.col("SSN_valid").alias("ssn_is_valid"),
        F.col("data_quality_score").alias("attributes_quality_score"),
        age_group(F.col("Age_clean")).alias("age_group"),
        occupation_category(F.col("Occupation_clean")).alias("occupation_category"),
    )


# fixed values: feature name of each silver column
FINANCIAL_NAMES = {
    "annual_income": "Annual_Income_clean",
    "monthly_salary": "Monthly_Inhand_Salary",
    "credit_mix": "Credit_Mix_clean",
    "payment_of_min_amount": "Payment_of_Min_Amount_clean",
    "credit_history_months": "Credit_History_Months",
    "credit_utilization_ratio": "Credit_Utilization_Ratio",
    "delay_from_due_date": "Delay_from_due_date",
    "num_loans": "Num_of_Loan_clean",
    "num_delayed_payments": "Num_of_Delayed_Payment_clean",
    "outstanding_debt": "Outstanding_Debt_clean",
    "total_emi_monthly": "Total_EMI_per_month",
    "amount_invested_monthly": "Amount_invested_monthly",
    "monthly_balance": "Monthly_Balance",
    "debt_to_income_ratio": "debt_to_income_ratio",
    "emi_to_income_ratio": "emi_to_income_ratio",
}


def financial_features(latest: DataFrame, *carried: str) -> DataFrame:
    """Model-facing names of the financial columns with risk flags and a health score."""
    named = latest.select(
        "Customer_ID", *carried, *[F.col(c).alias(name) for name, c in FINANCIAL_NAMES.items()]
    )
    flagged = named.withColumns(
        {
            "high_credit_utilization": indicator(F.col("credit_utilization_ratio") > 30),
            "high_debt_burden": indicator(F.col("debt_to_income_ratio") > F.lit(0.4)),
            "payment_issues": indicator(
                (F.col("num_delayed_payments") > 5) | (F.col("delay_from_due_date") > 30)
            ),
        }
    )
    good_signs = (
        indicator(F.col("credit_mix") == "Good")
        + indicator(F.col("payment_of_min_amount") == "Yes")
        + indicator(F.col("high_credit_utilization") == 0)
        + indicator(F.col("high_debt_burden") == 0)
        + indicator(F.col("payment_issues") == 0)
    )
    return flagged.withColumn("financial_health_score", good_signs / F.lit(5.0))


# --- combination -----------------------------------------------------------------------------


def customer_universe(*sources: DataFrame) -> DataFrame:
    """Every customer that occurs in any of the sources, once."""
    ids = [source.select(F.col("Customer_ID").cast("string").alias("Customer_ID")) for source in sources]
    result = ids[0]
    for more in ids[1:]:
        result = result.union(more)
    return result.distinct()


def universe_backfill(
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    start: str,
    end: str,
    months: int = 6,
    partitions: int | None = None,
) -> DataFrame:
    """Every customer of every snapshot: active in its lookback, or known from any time before it.

    A customer is one row with the first date of being known and the (few) dates of activity
    until these are spread over the snapshots.
    """
    day = F.col("snapshot_date")
    nothing, last = F.lit(None).cast("date"), F.lit(end).cast("date")
    active = lookback_span(clickstream, start, end, months).select(
        "Customer_ID", day.alias("_active"), nothing.alias("_known")
    )
    known = [
        df.where(day <= last).select("Customer_ID", nothing.alias("_active"), day.alias("_known"))
        for df in (attributes, financials)
    ]
    dated = active.union(known[0]).union(known[1])
    customers = (
        (dated.repartition(partitions, "Customer_ID") if partitions else dated)
        .groupBy("Customer_ID")
        .agg(F.min("_known").alias("_known"), F.collect_set("_active").alias("_active"))
    )
    always = _snapshots(F.col("_known"), last, start, end)
    lately = F.flatten(
        F.transform("_active", lambda d: _lookback_snapshots(d, start, end, months))
    )
    return customers.select("Customer_ID", F.explode(F.array_union(always, lately)).alias("snapshot"))


def join_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows per customer and snapshot with the one record, if any, whose span holds the snapshot.

    Only the customer is a join key, so rows that are distributed by customer stay where they are.
    The hint keeps Spark from a broadcast: it takes ``spans`` to be as small as what they were made of.
    """
    theirs = spans.withColumnRenamed("Customer_ID", "_customer").hint("shuffle_hash")
    within = (F.col("_from") <= F.col("snapshot")) & (F.col("snapshot") <= F.col("_until"))
    same = F.col("Customer_ID") == F.col("_customer")
    return rows.join(theirs, same & within, "left").drop("_customer", "_from", "_until")


def combine_customer_centric(
    customers: DataFrame, financial: DataFrame, attributes: DataFrame, clickstream: DataFrame, day: str
) -> DataFrame:
    """All customers with what each source knows about them, stamped with the snapshot."""
    combined = customers
    for features in (financial, attributes, clickstream):
        combined = combined.join(features, "Customer_ID", "left")
    return combined.withColumn("feature_snapshot_date", F.lit(day).cast("date"))


def with_interactions(df: DataFrame) -> DataFrame:
    """Age with income (a single-precision product), history and debt."""
    age, dti = F.col("age"), F.col("debt_to_income_ratio")
    age_income = (age.cast("float") * F.col("annual_income").cast("float")).cast("double")
    return df.withColumns(
        {
            "age_income_interaction": age_income / 1000000,
            "relative_credit_history": ratio_if_positive(F.col("credit_history_months"), age),
            "age_adjusted_debt_ratio": F.when(
                dti.isNotNull() & (age > 0), dti * (age / F.lit(40.0))
            ).otherwise(dti),
        }
    )


def with_availability(df: DataFrame) -> DataFrame:
    """Which sources know the customer, and the share of them that do."""
    flags = {
        "has_clickstream_data": "clickstream_record_count",
        "has_attributes_data": "age",
        "has_financial_data": "annual_income",
    }
    df = df.withColumns({name: F.col(c).isNotNull().cast("int") for name, c in flags.items()})
    known = F.col("has_clickstream_data") + F.col("has_attributes_data") + F.col("has_financial_data")
    return df.withColumn("data_completeness_score", known / F.lit(3.0))


def empty_features(spark: SparkSession, kind: str, inputs: Sequence[str] = ()) -> DataFrame:
    """No rows with the full columns of one feature set, for a source that has no data yet."""
    types = {
        "clickstream": clickstream_features(list(inputs)),
        "attributes": ATTRIBUTE_FEATURES,
        "financials": FINANCIAL_FEATURES,
    }[kind]
    return spark.createDataFrame([], ddl(types))


def feature_store(
    clickstream: DataFrame, attributes: DataFrame, financials: DataFrame, day: str, months: int = 6
) -> DataFrame:
    """Feature store of one snapshot from the three silver sources."""
    recent = lookback_slice(clickstream, day, months)
    known_attributes, known_financials = as_of_slice(attributes, day), as_of_slice(financials, day)
    combined = combine_customer_centric(
        customer_universe(recent, known_attributes, known_financials),
        financial_features(latest_record(known_financials, date="file_date")),
        attribute_features(latest_record(known_attributes, date="file_date")),
        clickstream_aggregates(recent),
        day,
    )
    return with_availability(with_interactions(combined))


def feature_store_backfill(
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    start: str,
    end: str,
    months: int = 6,
) -> DataFrame:
    """Feature store of every monthly snapshot from ``start`` to ``end`` in one job.

    Universe, statistics and latest records come out distributed by customer, over as many tasks as
    their rows need, so that putting them together takes no further shuffle.
    """
    recent = lookback_span(clickstream, start, end, months)
    tasks = backfill_partitions(start, end, recent, attributes, financials)
    finances = financial_features(latest_backfill(financials, start, end, tasks), "_from", "_until")
    people = attribute_features(latest_backfill(attributes, start, end, tasks), "_from", "_until")
    universe = universe_backfill(clickstream, attributes, financials, start, end, months, tasks)
    behaviour = clickstream_backfill(clickstream, start, end, months, partitions=tasks, universe=universe)
    combined = join_spans(join_spans(behaviour, finances), people)
    clicks = exclude(behaviour.columns, "Customer_ID", "snapshot")
    combined = combined.select("Customer_ID", "snapshot", *exclude(combined.columns, "Customer_ID", "snapshot", *clicks), *clicks)
    return with_availability(with_interactions(combined)).withColumnRenamed(
        "snapshot", "feature_snapshot_date"
    )
