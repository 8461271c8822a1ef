"""Preparation of training data: joins, splits, imputation, encoding, scaling, selection.

Fitting an operator gives a small description (medians, levels, means) that holds one entry per
column or category; applying it is a list of column expressions.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import exclude, iso_day
from ..functions.ordering import (
    exact_quantiles,
    long_form,
    positions,
    present,
)
from ..sources.schemas import ATTRIBUTE_FEATURES, FINANCIAL_FEATURES
from .calendar import TrainingWindow

# fixed values: columns that identify a row or tell the outcome
IDENTIFIERS = (
    "Customer_ID",
    "snapshot_date",
    "feature_snapshot_date",
    "loan_id",
    "label",
    "label_def",
    "ingestion_timestamp",
    "data_source",
    "processing_date",
)
MISSING_NUMBER = -999.0
MISSING_LEVEL = "Missing"
UNKNOWN_LEVEL = "Unknown"
MAX_LEVELS = 10_000


# Fitted expressions are SQL text: a saved pipeline keeps them as such, and ``F.expr`` applies them.


def _double(value: float) -> str:
    return f"{float(value)!r}D" if math.isfinite(value) else f"double('{value}')"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


# --- training rows -------------------------------------------------------------------------------


def training_rows(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels with the features of their customer at their own date; every label is kept."""
    keyed = features.withColumns(
        {
            "_customer": F.col("Customer_ID"),
            "_day": iso_day(F.col("feature_snapshot_date")),
        }
    ).drop("Customer_ID", "feature_snapshot_date")
    same = F.expr("Customer_ID = _customer AND CAST(snapshot_date AS DATE) = _day")
    return labels.join(keyed, same, "left").drop("_customer", "_day")


def with_period(rows: DataFrame, window: TrainingWindow) -> DataFrame:
    """Add ``period``: in the train/test span, in the out-of-time span, or NULL."""
    day = F.col("snapshot_date").cast("date")

    def between(start: str, end: str) -> Column:
        return day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))

    period = F.when(between(window.train_test_start, window.train_test_end), "train_test").when(
        between(window.oot_start, window.oot_end), "oot"
    )
    return rows.withColumn("period", period)


def test_rows(n: int, train_ratio: float) -> int:
    """How many of ``n`` ordered rows form the test part: its share, rounded up."""
    return math.ceil((1 - train_ratio) * n)


def with_ordered_split(
    rows: DataFrame, train_ratio: float = 0.8, date: str = "snapshot_date", key: str = "loan_id"
) -> DataFrame:
    """Add ``split``: the first part of the rows by (date, key) trains, the rest tests.

    No global sort: rows per date (few) give the date the cut falls on, and only that date's keys
    are ordered.  Rows that share the last training key are told apart by a hash of all columns, so
    the sizes of both parts are exact; only rows equal in every column stay together.
    """
    per_date = rows.groupBy(date).agg(F.count("*").alias("n"))
    running = W.orderBy(date).rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.orderBy(date).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total, upto = F.sum("n").over(everything), F.sum("n").over(running)
    train_size = total - F.ceil((1 - F.lit(train_ratio)) * total)
    reached = per_date.select(
        date, (upto - F.col("n")).alias("_before"), upto.alias("_upto"), train_size.alias("_train")
    ).where((F.col("_before") < F.col("_train")) & (F.col("_train") <= F.col("_upto")))
    cut = reached.select(
        F.col(date).alias("_cut"), (F.col("_train") - F.col("_before") - 1).alias("_place")
    )
    tie = F.lpad(F.hex(F.xxhash64(*rows.columns)), 16, "0")
    own_key = F.struct(F.col(key).cast("string").alias("k"), tie.alias("h"))
    on_cut = rows.where(F.col(date) == cut.select("_cut").scalar()).select(own_key.alias("_key"))
    # order of text with a separator below every character of a key equals that of the pair
    spread = F.concat(F.coalesce("_key.k", F.lit("")), F.lit("\x00"), F.col("_key.h"))
    placed = positions(on_cut, [], ["_key"], spread, text=True)
    last = placed.where(F.col("position") == cut.select("_place").scalar()).select("_key")
    cut_date, last_key = cut.select("_cut").scalar(), last.scalar()
    trains = (F.col(date) < cut_date) | ((F.col(date) == cut_date) & (own_key <= last_key))
    return rows.withColumn("split", F.when(trains, "train").otherwise("test"))


def with_splits(
    rows: DataFrame, window: TrainingWindow, train_ratio: float = 0.8
) -> DataFrame:
    """Rows of both spans with ``split``: train, test or oot."""
    marked = with_period(rows, window)
    inside = with_ordered_split(marked.where("period = 'train_test'"), train_ratio)
    later = marked.where("period = 'oot'").withColumn("split", F.lit("oot"))
    return inside.unionByName(later).drop("period")


def with_folds(
    rows: DataFrame, folds: int, seed: int, label: str = "label", key: str = "loan_id"
) -> DataFrame:
    """Add ``fold``: rows dealt out in hashed order within each class, so classes stay even."""
    hashed = rows.withColumn(
        "_hash", F.xxhash64(F.col(key).cast("string"), F.col("snapshot_date").cast("string"), F.lit(seed))
    )
    placed = positions(hashed, [label], ["_hash"], F.col("_hash"))
    return placed.withColumn("fold", F.pmod("position", F.lit(folds)).cast("int")).drop(
        "_hash", "position", "group_size"
    )


# --- which columns -------------------------------------------------------------------------------

# fixed values: column lists of the three model families, and what they leave out
REGRESSION_GROUPS = {
    "financial": [
        "annual_income",
        "monthly_salary",
        "debt_to_income_ratio",
        "emi_to_income_ratio",
        "credit_utilization_ratio",
        "financial_health_score",
        "outstanding_debt",
    ],
    "demographic": ["age", "credit_history_months"],
    "categorical": ["age_group", "occupation_category", "credit_mix", "payment_of_min_amount"],
    "quality": ["data_completeness_score", "has_financial_data", "has_clickstream_data"],
}
REGRESSION_DIGITS = ("1", "2", "3", "5", "7", "10")
#: columns of a source that the random forest does without
FOREST_WITHOUT = {
    "financial": {"delay_from_due_date", "num_loans", "amount_invested_monthly"},
    "attribute": {"ssn_is_valid"},
    "clickstream": {"record_count", "time_span_days"},
}
INTERACTIONS = ("age_income_interaction", "relative_credit_history", "age_adjusted_debt_ratio")
AVAILABILITY = ("has_clickstream_data", "has_attributes_data", "has_financial_data", "data_completeness_score")

_CLICK = re.compile(r"(fe_\d+|clickstream)_(\w+)")


@dataclass(frozen=True)
class Described:
    """What a feature-store column is: its source, and for clickstream the input and the statistic."""

    name: str
    source: str
    input: str = ""
    statistic: str = ""


def described(column: str) -> Described:
    """A column by the schemas of the sources that feed the store."""
    if column in IDENTIFIERS:
        return Described(column, "identifier")
    click = _CLICK.fullmatch(column)
    if click:
        return Described(column, "clickstream", click[1], click[2])
    sources = {
        "financial": FINANCIAL_FEATURES,
        "attribute": ATTRIBUTE_FEATURES,
        "interaction": INTERACTIONS,
        "availability": AVAILABILITY,
    }
    return Described(column, next((s for s, names in sources.items() if column in names), "other"))


def regression_columns(columns: Sequence[str], clickstream_limit: int = 10) -> list[str]:
    """Columns of the logistic regression: fixed lists and the first clickstream means and deviations."""
    present = {d.name: d for d in map(described, columns)}
    clicks = [
        d.name
        for d in present.values()
        if d.statistic in ("mean", "std") and set(REGRESSION_DIGITS) & _digit_runs(d.input)
    ]
    lists = {**REGRESSION_GROUPS, "clickstream": clicks[:clickstream_limit]}
    order = ("financial", "demographic", "categorical", "clickstream", "quality")
    return [name for group in order for name in lists[group] if name in present]


def _digit_runs(name: str) -> set[str]:
    """All stretches of digits inside a name: 12 holds 1, 2 and 12."""
    digits = name.rpartition("_")[2]
    return {digits[i:j] for i in range(len(digits)) for j in range(i + 1, len(digits) + 1)}


def forest_columns(columns: Sequence[str]) -> list[str]:
    """Columns of the random forest: what each source offers but for its exceptions."""
    by_source: dict[str, list[str]] = {}
    for d in map(described, columns):
        if (d.statistic or d.name) not in FOREST_WITHOUT.get(d.source, ()):
            by_source.setdefault(d.source, []).append(d.name)
    order = ("financial", "clickstream", "interaction", "attribute", "availability")
    return list(dict.fromkeys(name for source in order for name in by_source.get(source, ())))


def boosting_columns(columns: Sequence[str]) -> list[str]:
    """Every column that describes a customer, known to the schemas or not."""
    return [d.name for d in map(described, columns) if d.source != "identifier" and not d.name.startswith("Unnamed")]


def numeric_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    kinds = (T.NumericType, T.BooleanType)
    return [c for c in columns if isinstance(df.schema[c].dataType, kinds)]


def text_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


# --- imputation ----------------------------------------------------------------------------------


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of the present values per column."""
    return exact_quantiles(long_form(df, [], columns), ["feature"], "value", {"median": 0.5})


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent text per column, the first in order on a tie."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        texts.unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )
    first = F.min(F.struct((-F.col("n")).alias("_less"), "value"))
    return counts.groupBy("feature").agg(first["value"].alias("mode"))


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Medians as a dict; a column without values imputes 0."""
    found = {r.feature: r["median"] for r in medians(df, columns).collect()} if columns else {}
    return {c: found.get(c, 0.0) for c in columns}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    found = {r.feature: r["mode"] for r in modes(df, columns).collect()} if columns else {}
    return {c: found.get(c, UNKNOWN_LEVEL) for c in columns}


def number_or(column: str, value: float) -> str:
    """The number as double, or ``value`` where it is missing."""
    c = f"CAST(`{column}` AS DOUBLE)"
    return f"CASE WHEN {c} IS NULL OR isnan({c}) THEN {_double(value)} ELSE {c} END"


def text_or(column: str, value: str) -> str:
    """The text, or ``value`` where it is missing."""
    return f"coalesce(CAST(`{column}` AS STRING), {_text(value)})"


def imputed(df: DataFrame, numbers: Mapping[str, float], texts: Mapping[str, str]) -> DataFrame:
    """Fill missing numbers and texts with the given values."""
    filled = {c: F.expr(number_or(c, v)) for c, v in numbers.items()}
    filled |= {c: F.expr(text_or(c, v)) for c, v in texts.items()}
    return df.withColumns(filled)


def sentinel_filled(df: DataFrame, columns: Sequence[str], value: float = MISSING_NUMBER) -> DataFrame:
    """Missing numbers as one value far outside their range."""
    return df.withColumns({c: F.expr(number_or(c, value)) for c in columns})


# --- encoding ------------------------------------------------------------------------------------


def level_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every level of every column with its place in alphabetical order."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    levels = texts.unpivot([], list(columns), "feature", "level").where(F.col("level").isNotNull())
    placed = positions(levels.distinct(), ["feature"], ["level"], F.col("level"), text=True)
    return placed.select("feature", "level", F.col("position").alias("code"))


def fit_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Levels per column in alphabetical order.

    They become columns or constants of the model, so a column with an excessive number of levels
    is an error, not something to cut down.
    """
    if not columns:
        return {}
    codes = level_codes(df, columns)
    sizes = {r.feature: r["count"] for r in codes.groupBy("feature").count().collect()}
    excessive = {c: n for c, n in sizes.items() if n > MAX_LEVELS}
    if excessive:
        raise ValueError(f"too many levels to encode: {excessive}")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in codes.orderBy("feature", "code").collect():
        found[row.feature].append(row.level)
    return found


def one_hot(column: str, levels: Sequence[str], text: str | None = None) -> dict[str, str]:
    """Indicator per level after the first; the first and unknown levels are all zeros.

    ``text`` replaces the plain column, for instance by its imputed form.
    """
    value = text or f"`{column}`"
    return {
        f"{column}_{level}": f"CASE WHEN {value} = {_text(level)} THEN 1.0D ELSE 0.0D END"
        for level in levels[1:]
    }


def level_code(column: str, levels: Sequence[str], text: str | None = None) -> str:
    """Place of the level in alphabetical order; unknown levels count as the first."""
    if not levels:
        return "0.0D"
    known = ", ".join(map(_text, levels))
    place = f"array_position(array({known}), {text or f'`{column}`'})"
    return f"CAST(greatest(coalesce({place}, 1), 1) - 1 AS DOUBLE)"


# --- scaling and selection -----------------------------------------------------------------------


def scale_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column."""
    return (
        long_form(df, [], columns)
        .groupBy("feature")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"))
    )


def fit_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    rows = scale_statistics(df, columns).collect()
    return {r.feature: (r["mean"], r.deviation) for r in rows}


def standardized(value: str, mean: float, deviation: float) -> str:
    """Distance from the mean in deviations; a constant column is only centred."""
    return f"(({value}) - {_double(mean)}) / {_double(deviation or 1.0)}"


def f_statistics(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """One-way analysis of variance of every column over the classes of the label."""
    per_class = (
        long_form(df, [label], columns)
        .where(present(F.col("value")))
        .groupBy("feature", label)
        .agg(
            F.count("*").alias("n"),
            F.avg("value").alias("mean"),
            F.var_pop("value").alias("variance"),
        )
    )
    n = F.col("n")
    whole = per_class.withColumn(
        "_grand", F.sum(n * F.col("mean")).over(_per_feature()) / F.sum(n).over(_per_feature())
    )
    between = F.sum(n * F.pow(F.col("mean") - F.col("_grand"), 2)) / (F.count("*") - 1)
    inside = F.sum(n * F.col("variance")) / (F.sum(n) - F.count("*"))
    return whole.groupBy("feature").agg(F.try_divide(between, inside).alias("f_statistic"))


def _per_feature():
    """Window over the classes of one column."""
    return W.partitionBy("feature")


def top_features(statistics: DataFrame, k: int) -> DataFrame:
    """The ``k`` columns with the largest F statistic."""
    known = F.col("f_statistic").isNotNull()
    return statistics.where(known).orderBy(F.desc("f_statistic"), "feature").limit(k)


def preparation_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of rows and of feature columns by kind, and the mean number of missing values."""
    kinds = exclude(columns, *IDENTIFIERS)
    missing = [F.count_if(F.col(c).isNull()) for c in kinds]
    total = missing[0]
    for m in missing[1:]:
        total = total + m
    return df.agg(F.count("*").alias("rows"), (total / len(kinds)).alias("mean_missing")).select(
        "rows",
        F.lit(len(df.columns)).alias("original_features"),
        F.lit(len(kinds)).alias("selected_features"),
        F.lit(len(text_columns(df, kinds))).alias("categorical_features"),
        F.lit(len(numeric_columns(df, kinds))).alias("numerical_features"),
        "mean_missing",
    )
