"""Data profiles: completeness, distributions, outliers, stability and association.

Profiles of many columns work on the long form (one row per value), so one grouped plan covers
all columns.  Quantiles are exact and go through ``functions.ordering``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import equal_width_bin, indicator, month_start, without_underscores
from ..functions.ordering import exact_quantiles, long_form, present, value_counts

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _missing(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    fractional = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return c.isNull() | F.isnan(c) if fractional else c.isNull()


def _tagged(sources: Mapping[str, DataFrame], *columns: str) -> DataFrame:
    """The given columns of all sources in one frame with the name of the source."""
    frames = [df.select(F.lit(name).alias("source"), *columns) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, frames)


# --- completeness and duplicates ---------------------------------------------------------------


def distinct_customers(sources: Mapping[str, DataFrame], key: str = "Customer_ID") -> DataFrame:
    """Number of different customers per source."""
    return _tagged(sources, key).groupBy("source").agg(F.count_distinct(key).alias("customers"))


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column that misses any, from one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(_missing(df, c)).alias(c) for c in df.columns]
    )
    percentage = F.col("missing") * 100.0 / F.col("_rows")
    return (
        counts.unpivot("_rows", df.columns, "column", "missing")
        .where("missing > 0")
        .select("column", "missing", percentage.alias("missing_pct"))
    )


def _fingerprint(columns: Sequence[str]) -> list[Column]:
    """128 bits of a row: two hashes, the second with another beginning."""
    values = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(*values), F.xxhash64(F.lit("second"), *values)]


def duplicate_rows(df: DataFrame, narrow: int = 4) -> DataFrame:
    """Rows beyond the first of each set of equal rows.

    Only fingerprints are counted over all rows.  Whole rows are moved, and compared, where a fingerprint is
    seen twice, so the result is exact whatever the hashes.  Tables of at most ``narrow`` columns are counted by
    their rows at once.
    """
    counted, copies = df, max(df.columns, key=len) + "_"  # longer than every column's name
    if len(df.columns) > narrow:
        marked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[
            f.alias(name) for f, name in zip(_fingerprint(df.columns), ("f1", "f2"))
        ])
        seen = marked.groupBy("f1", "f2").agg(F.count("*").alias("n")).where("n > 1")
        counted = marked.join(seen.select("f1", "f2"), ["f1", "f2"], "left_semi").select("row.*")
    return (
        counted.groupBy(*[F.col(f"`{c}`") for c in df.columns])
        .agg(F.count("*").alias(copies))
        .agg(F.coalesce(F.sum(F.col(f"`{copies}`") - 1), F.lit(0)).alias("duplicate_rows"))
    )


# --- summaries ---------------------------------------------------------------------------------


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum of every column."""
    values = long_form(df, [], columns).where(present(F.col("value")))
    moments = values.groupBy("feature").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return moments.join(exact_quantiles(values, ["feature"], "value", QUARTILES), "feature")


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, number of different texts, the most frequent one (first in order on a tie) and its count."""
    counts = _text_counts(df, columns)
    most = F.min(F.struct((-F.col("n")).alias("negative"), "value"))
    return (
        counts.groupBy("feature")
        .agg(F.sum("n").alias("count"), F.count("*").alias("unique"), most.alias("most"))
        .select(
            "feature",
            "count",
            "unique",
            F.col("most.value").alias("top"),
            (-F.col("most.negative")).alias("freq"),
        )
    )


def _text_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
    )


def top_values(
    df: DataFrame, column: str, k: int, excluded: Sequence[str] = (), pattern: str | None = None
) -> DataFrame:
    """The ``k`` most frequent values, without placeholders."""
    value = F.col(column)
    kept = df.where(value.isNotNull())
    if excluded:
        kept = kept.where(~value.isin(list(excluded)))
    if pattern is not None:
        kept = kept.where(~value.rlike(pattern))
    counts = kept.groupBy(value.alias("value")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "value").limit(k)


def quartiles_by(df: DataFrame, group: str, value: str) -> DataFrame:
    """Box-plot figures of a value per category."""
    kept = df.where(F.col(group).isNotNull())
    figures = {"low": 0.0, **QUARTILES, "high": 1.0}
    return exact_quantiles(kept, [group], value, figures)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over rows where both are present.

    All pairs are aggregates of one pass; the result is in long form.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    values = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")) for a, b in pairs]
    wide = df.agg(*[v.alias(f"_{i}") for i, v in enumerate(values)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(
                F.struct(
                    F.lit(left).alias("feature_a"),
                    F.lit(right).alias("feature_b"),
                    F.col(f"_{i}").alias("correlation"),
                )
            )
    return wide.select(F.inline(F.array(*cells)))


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample variance per column, largest first."""
    return (
        long_form(df, [], columns)
        .groupBy("feature")
        .agg(F.var_samp("value").alias("variance"))
        .orderBy(F.desc("variance"))
    )


# --- outliers ----------------------------------------------------------------------------------


def iqr_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the limits 1.5 interquartile ranges outside the quartiles."""
    quartiles = exact_quantiles(
        long_form(df, [], columns), ["feature"], "value", {"q25": 0.25, "q75": 0.75}
    )
    spread = 1.5 * (F.col("q75") - F.col("q25"))
    return quartiles.select(
        "feature",
        (F.col("q25") - spread).alias("lower_bound"),
        (F.col("q75") + spread).alias("upper_bound"),
    )


def _against_bounds(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form next to its column's bounds; there is one bound row per column."""
    bounds = F.broadcast(iqr_bounds(df, columns))
    return long_form(df, keys, columns).join(bounds, "feature")


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Outliers below and above the bounds of every column, as counts and share of all rows."""
    low, high = F.col("value") < F.col("lower_bound"), F.col("value") > F.col("upper_bound")
    counted = (
        _against_bounds(df, [], columns)
        .groupBy("feature", "lower_bound", "upper_bound")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(low).alias("lower_count"),
            F.count_if(high).alias("upper_count"),
        )
    )
    total = F.col("lower_count") + F.col("upper_count")
    return counted.select(
        "feature",
        total.alias("total_count"),
        F.round(total * 100.0 / F.col("rows"), 2).alias("percentage"),
        "lower_count",
        "upper_count",
        "lower_bound",
        "upper_bound",
    )


def outlier_tally(df: DataFrame, columns: Sequence[str], key: str = "Customer_ID") -> DataFrame:
    """Outlying values per customer, over all columns."""
    value = F.col("value")
    outside = (value < F.col("lower_bound")) | (value > F.col("upper_bound"))
    return (
        _against_bounds(df, [key], columns)
        .where(outside)
        .groupBy(key)
        .agg(F.count("*").alias("outliers"))
    )


def tally_histogram(tally: DataFrame) -> DataFrame:
    """How many customers have each number of outliers."""
    return tally.groupBy("outliers").agg(F.count("*").alias("customers")).orderBy("outliers")


# --- histograms --------------------------------------------------------------------------------


def histogram(
    df: DataFrame,
    columns: Sequence[str],
    bins: int,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Equal-width bin counts per column between its smallest and largest (kept) value."""
    values = long_form(df, [], columns).where(present(F.col("value")))
    if low is not None:
        values = values.where(F.col("value") >= low)
    if high is not None:
        values = values.where(F.col("value") <= high)
    return _binned(values, bins)


def unit_histogram(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Counts per whole number within a range."""
    value = F.col(column).cast("double")
    return (
        df.where(value.between(low, high))
        .groupBy(F.floor(value).alias("unit"))
        .agg(F.count("*").alias("count"))
    )


def trimmed_histogram(
    df: DataFrame, columns: Sequence[str], bins: int, low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """Histogram of the values between two quantiles of their column."""
    values = long_form(df, [], columns).where(present(F.col("value")))
    limits = exact_quantiles(values, ["feature"], "value", {"trim_low": low, "trim_high": high})
    kept = values.join(F.broadcast(limits), "feature").where(
        F.col("value").between(F.col("trim_low"), F.col("trim_high"))
    )
    return _binned(kept.select("feature", "value"), bins)


def _binned(values: DataFrame, bins: int) -> DataFrame:
    ranges = values.groupBy("feature").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )
    placed = values.join(F.broadcast(ranges), "feature")
    place = equal_width_bin(F.col("value"), F.col("low"), F.col("high"), bins)
    return placed.groupBy("feature", place.alias("bin")).agg(
        F.count("*").alias("count"),
        F.min("value").alias("smallest"),
        F.max("value").alias("largest"),
    )


def grid_counts(df: DataFrame, x: str, y: str, bins_x: int, bins_y: int) -> DataFrame:
    """Counts on a grid of equal-width bins over the range of two columns."""
    def place(name: str, bins: int) -> Column:
        limits = [df.agg(edge(F.col(name).cast("double"))).scalar() for edge in (F.min, F.max)]
        return equal_width_bin(F.col(name).cast("double"), *limits, bins)

    return df.groupBy(place(x, bins_x).alias("bin_x"), place(y, bins_y).alias("bin_y")).agg(
        F.count("*").alias("count")
    )


# --- behaviour over time -------------------------------------------------------------------------


def records_per_month(sources: Mapping[str, DataFrame], date: str = "snapshot_date") -> DataFrame:
    """Records per source and calendar month."""
    return (
        _tagged(sources, date)
        .groupBy("source", F.to_date(month_start(F.col(date))).alias("month"))
        .agg(F.count("*").alias("count"))
    )


def monthly_statistics(
    df: DataFrame, columns: Sequence[str], date: str = "snapshot_date"
) -> DataFrame:
    """Mean, deviation, median and number of rows per column and month."""
    dated = df.where(F.col(date).isNotNull()).withColumn(
        "month", F.to_date(month_start(F.col(date)))
    )
    values = long_form(dated, ["month"], columns)
    keys = ["feature", "month"]
    moments = values.groupBy(*keys).agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.count("*").alias("count"),
    )
    return moments.join(exact_quantiles(values, keys, "value", {"median": 0.5}), keys, "left")


def feature_stability(
    df: DataFrame, columns: Sequence[str], date: str = "snapshot_date"
) -> DataFrame:
    """How much monthly means and medians of a column vary, relative to their own mean.

    NULL for a column with fewer than two months or a zero mean.
    """

    def relative(c: str) -> Column:
        return F.when(F.count("*") > 1, F.try_divide(F.stddev_samp(c), F.avg(c)))

    return (
        monthly_statistics(df, columns, date)
        .groupBy("feature")
        .agg(
            F.count("*").alias("periods"),
            relative("mean").alias("mean_coef_of_variation"),
            relative("median").alias("median_coef_of_variation"),
        )
    )


def feature_variability(
    df: DataFrame, columns: Sequence[str], threshold: float = 0.01
) -> DataFrame:
    """Coefficient of variation of the columns where it exceeds the threshold.

    A zero mean counts as infinite variation; a constant column is left out.
    """
    mean, std = F.col("mean"), F.col("std")
    cv = F.when(mean == 0, F.lit(float("inf"))).otherwise(std / F.abs(mean))
    return (
        long_form(df, [], columns)
        .groupBy("feature")
        .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
        .where(std > 0)
        .select("feature", cv.alias("cv"))
        .where(F.col("cv") > threshold)
    )


def availability_over_time(sources: Mapping[str, DataFrame], dates: Sequence[str]) -> DataFrame:
    """Per date: customers and records of each source so far, and customers known to all of them.

    A record is counted for every date it precedes; customers are collapsed per date first.
    """
    later = F.filter(
        F.array(*[F.lit(d).cast("date") for d in dates]), lambda d: d >= F.col("snapshot_date")
    )
    seen = _tagged(sources, "Customer_ID", "snapshot_date").select(
        "source", "Customer_ID", F.explode(later).alias("analysis_date")
    )
    per_customer = seen.groupBy("analysis_date", "Customer_ID").agg(
        *[F.count_if(F.col("source") == name).alias(name) for name in sources]
    )
    known = {name: F.col(name) > 0 for name in sources}
    named = F.col("Customer_ID").isNotNull()
    return per_customer.groupBy("analysis_date").agg(
        *[F.count_if(known[name] & named).alias(f"{name}_customers") for name in sources],
        F.count_if(reduce(and_, known.values()) & named).alias("all_sources"),
        *[F.sum(name).alias(f"{name}_records") for name in sources],
    )


# --- information content -------------------------------------------------------------------------


def feature_potential(
    df: DataFrame, numeric: Sequence[str], text: Sequence[str] = ()
) -> DataFrame:
    """Score per column: 0.4 completeness + 0.4 variability + 0.2 uniqueness.

    Variability is the coefficient of variation up to 1 for numbers, and entropy relative to its
    maximum for text.  Columns without any value are left out.
    """
    rows = df.agg(F.count("*")).scalar()
    parts = []
    if numeric:
        values = long_form(df, [], numeric)
        different = value_counts(values, ["feature"], "value").groupBy("feature")
        spread = values.groupBy("feature").agg(
            F.count("value").alias("present"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
        )
        cv = F.col("std") / F.abs("mean")
        varied = (F.col("std") > 0) & (F.abs("mean") > 0)
        parts.append(
            spread.join(different.agg(F.count("*").alias("different")), "feature").select(
                "feature",
                "present",
                "different",
                F.when(varied, F.least(cv, F.lit(1.0))).otherwise(0.0).alias("variability"),
            )
        )
    if text:
        n = F.col("n").cast("double")
        entropy = F.ln(F.sum(n)) - F.sum(n * F.ln(n)) / F.sum(n)
        share = F.when(F.count("*") > 1, F.try_divide(entropy, F.ln(F.count("*"))))
        parts.append(
            _text_counts(df, text)
            .groupBy("feature")
            .agg(
                F.sum("n").alias("present"),
                F.count("*").alias("different"),
                F.coalesce(share, F.lit(0.0)).alias("variability"),
            )
        )
    completeness = F.col("present") / rows
    uniqueness = F.least(F.lit(1.0), F.col("different") / rows)
    score = 0.4 * completeness + 0.4 * F.col("variability") + 0.2 * uniqueness
    return reduce(DataFrame.unionByName, parts).select(
        "feature",
        score.alias("potential_score"),
        completeness.alias("completeness"),
        "variability",
        uniqueness.alias("uniqueness"),
    )


def binned_mutual_information(
    df: DataFrame, columns: Sequence[str], target: str, bins: int = 10
) -> DataFrame:
    """Mutual information (nats) of each column with the target, both cut at exact quantiles.

    A value belongs to the bin given by the number of inner quantiles below it, so equal values
    share a bin.  Rows with a missing value in any column are left out.
    """
    everything = [*columns, target]
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in everything]).dropna()
    inner = {f"cut_{i}": i / bins for i in range(1, bins)}
    cuts = exact_quantiles(long_form(complete, [], everything), ["feature"], "value", inner)

    def place(value: str, prefix: str) -> Column:
        return reduce(add, [indicator(F.col(value) > F.col(f"{prefix}{c}")) for c in inner])

    of_target = F.col("feature") == target
    cuts = cuts.select(
        "*", *[F.max(F.when(of_target, F.col(c))).over(_cells()).alias(f"target_{c}") for c in inner]
    )
    pairs = long_form(complete.withColumn("_target", F.col(target)), ["_target"], columns)
    joint = (
        pairs.join(F.broadcast(cuts), "feature")
        .groupBy(
            "feature", place("value", "").alias("bin_x"), place("_target", "target_").alias("bin_y")
        )
        .agg(F.count("*").alias("n"))
    )

    def total(*keys: str) -> Column:
        return F.sum("n").over(_cells(*keys)).cast("double")

    informed = joint.select(
        "feature",
        "n",
        total("feature").alias("all"),
        total("feature", "bin_x").alias("n_x"),
        total("feature", "bin_y").alias("n_y"),
    )
    n = F.col("n")
    term = n / F.col("all") * F.ln(n * F.col("all") / (F.col("n_x") * F.col("n_y")))
    return informed.groupBy("feature").agg(F.sum(term).alias("mutual_information"))


def _cells(*keys: str) -> WindowSpec:
    """Window over small frames: one row per column, or per column and pair of bins."""
    return Window.partitionBy(*keys)


# --- text quality --------------------------------------------------------------------------------

# fixed values: patterns of well-formed text
STRICT_SSN = r"^([0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{9})$"
ONLY_UNDERSCORES = r"^_+$"


def _shown(column: str) -> Column:
    """Text of a value as it would be printed; a missing one reads ``nan``."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def age_text_quality(df: DataFrame, column: str = "Age") -> DataFrame:
    """Ages with characters that no number has, with underscores, and outside 0 to 120."""
    shown = _shown(column)
    age = without_underscores(F.col(column)).try_cast("double")
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(shown.rlike(r"[^0-9.\-]")).alias("non_numeric"),
        F.count_if(shown.contains("_")).alias("with_underscore"),
        F.count_if((age < 0) | (age > 120)).alias("out_of_range"),
    )


def ssn_text_quality(df: DataFrame, column: str = "SSN") -> DataFrame:
    """Numbers that miss the strict pattern, and those with foreign characters."""
    shown = _shown(column)
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(~shown.rlike(STRICT_SSN)).alias("not_matching"),
        F.count_if(shown.rlike(r"[^0-9\-]")).alias("special_characters"),
    )


def _per_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[_shown(c).alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "shown"
    )


def underscore_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values with an underscore per column."""
    found = F.count_if(F.col("shown").contains("_"))
    return _per_column(df, columns).groupBy("column").agg(
        found.alias("with_underscore"), (found * 100.0 / F.count("*")).alias("percentage")
    )


def placeholder_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Different values (missing counts as one), blanks and underscore-only values per column."""
    counts = _per_column(df, columns).groupBy("column", "shown").agg(F.count("*").alias("n"))
    blank = F.sum(F.when(F.col("shown") == "", F.col("n")).otherwise(0))
    lines = F.sum(F.when(F.col("shown").rlike(ONLY_UNDERSCORES), F.col("n")).otherwise(0))
    return counts.groupBy("column").agg(
        F.count("*").alias("different"),
        blank.alias("blank"),
        lines.alias("placeholder"),
        (lines * 100.0 / F.sum("n")).alias("placeholder_pct"),
    )


def attribute_quality_split(df: DataFrame) -> DataFrame:
    """Valid and invalid records per demographic field.

    A value with an underscore is counted as such, not as an invalid age.
    """
    age = without_underscores(F.col("Age")).try_cast("double")
    counted = df.agg(
        F.count("*").alias("total"),
        F.count_if(_shown("Age").contains("_")).alias("age_underscore"),
        F.count_if((age < 18) | (age > 90) | age.isNull()).alias("_age_bad"),
        F.count_if(_shown("SSN").rlike(r"[^0-9\-]")).alias("ssn_corrupted"),
        F.count_if(_shown("Occupation").rlike(ONLY_UNDERSCORES)).alias("occupation_placeholder"),
    )
    age_invalid = F.col("_age_bad") - F.col("age_underscore")
    total = F.col("total")
    return counted.select(
        "total",
        (total - F.col("age_underscore") - age_invalid).alias("age_valid"),
        "age_underscore",
        age_invalid.alias("age_invalid"),
        (total - F.col("ssn_corrupted")).alias("ssn_valid"),
        "ssn_corrupted",
        (total - F.col("occupation_placeholder")).alias("occupation_valid"),
        "occupation_placeholder",
    )


# --- training data -------------------------------------------------------------------------------


def training_data_quality(
    df: DataFrame, label: str = "label",
    identifiers: Sequence[str] = ("Customer_ID", "snapshot_date", "label", "label_def"),
) -> DataFrame:
    """One row on missing values, class balance and size, with the list of raised flags."""
    features = [c for c in df.columns if c not in identifiers]
    missing = {c: F.count_if(_missing(df, c)) for c in features}
    counts = df.agg(
        F.count("*").alias("rows"), *[m.alias(f"_{c}") for c, m in missing.items()]
    )
    classes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    majority = classes.agg(F.max("n") / F.sum("n")).scalar()

    def names_where(condition) -> Column:
        named = [F.when(condition(F.col(f"_{c}")), F.lit(c)) for c in features]
        return F.array_compact(F.array(*named))

    total = reduce(add, [F.col(f"_{c}") for c in features])
    report = counts.select(
        "rows",
        F.lit(len(features)).alias("columns"),
        total.alias("total_missing"),
        F.try_divide(total * 100.0, F.col("rows") * len(features)).alias("missing_percentage"),
        names_where(lambda m: m > 0).alias("columns_with_missing"),
        names_where(lambda m: m / F.col("rows") > 0.5).alias("high_missing_columns"),
        majority.alias("majority_share"),
    )
    report = report.withColumn("is_balanced", F.abs(F.col("majority_share") - 0.5) < 0.3)
    flags = F.array_compact(
        F.array(
            F.when(F.col("missing_percentage") > 20, "HIGH_MISSING_VALUES"),
            F.when(~F.col("is_balanced"), "IMBALANCED_LABELS"),
            F.when(F.col("rows") < 1000, "SMALL_SAMPLE_SIZE"),
            F.when(F.size("high_missing_columns") > 0, "HIGH_MISSING_FEATURES"),
        )
    )
    return report.withColumn("data_quality_flags", flags)


def split_rates(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Size and class rate of every split."""
    return df.groupBy(split).agg(F.count("*").alias("rows"), F.avg(label).alias("rate"))


def attribute_quality_at(attributes: DataFrame, cutoff: str) -> DataFrame:
    """Share of valid ages and numbers among cleaned demographics known at a date."""
    known = attributes.where(F.col("snapshot_date") <= F.lit(cutoff).cast("date"))
    share = lambda c: F.avg(F.col(c).cast("int")) * 100
    return known.agg(
        F.count("*").alias("records"),
        share("Age_valid").alias("valid_age_pct"),
        share("SSN_valid").alias("valid_ssn_pct"),
    )


def score_summary(df: DataFrame, score: str, label: str) -> DataFrame:
    """Range of the scores, class counts, and missing scores and labels."""
    return df.agg(
        F.count("*").alias("rows"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label).isNull()).alias("missing_labels"),
        (F.avg(F.col(label).isNull().cast("int")) * 100).alias("missing_labels_pct"),
        F.count_if(F.col(score).isNull()).alias("missing_scores"),
        (F.avg(F.col(score).isNull().cast("int")) * 100).alias("missing_scores_pct"),
    )
