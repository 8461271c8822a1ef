"""Exact order statistics that never bring a whole group into one task.

A plain window or ``percentile`` over a large group sorts or hashes all of it in one task.
The functions here work in two levels instead: values are first collapsed to counts (a hot
value becomes one row already on the map side), then cut into *buckets* at quantiles of the
group's own values.  Bucket totals are few and give every bucket its start; the running total
inside a bucket is a window partitioned by (keys, bucket).  The quantiles are approximate, but
they only spread the work: results do not depend on them.  NULL keys form a group of their own,
NULL values come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 128  # per group
#: steps of the search for a bucket: a group has less than 1024 cut points
SEARCH = [1 << k for k in range(9, -1, -1)]
#: share of a number group's distinct values, chosen by hash, that place its cut points
SAMPLED = 16


def present(value: Column) -> Column:
    """Neither NULL nor NaN."""
    return value.isNotNull() & ~F.isnan(value.cast("double"))


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equal keys, NULL equal to NULL; without keys every row matches."""
    same = F.col(f"{left}._all") == F.col(f"{right}._all")
    for key in keys:
        same = same & F.col(f"{left}.`{key}`").eqNullSafe(F.col(f"{right}.`{key}`"))
    return same


def _never_null(key: str, kind: T.DataType) -> tuple[Column, Column]:
    """A key as two columns that are never NULL, so that joins and windows share one distribution."""
    c = F.col(f"`{key}`")
    if isinstance(kind, (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.BooleanType)):
        default = {T.StringType: "", T.DateType: "1970-01-01", T.TimestampType: "1970-01-01", T.BooleanType: "false"}
        return F.coalesce(c, F.lit(default.get(type(kind), "0")).cast(kind)), c.isNull()
    return F.coalesce(F.to_json(F.struct(c)), F.lit("")), c.isNull()


def _cuts(marked: DataFrame, keys: Sequence[str], text: bool, weights: Sequence[str] = ()) -> DataFrame:
    """Per group at most about ``BUCKETS`` ascending values that cut it into even parts.

    They only spread the work, so a hashed part of the rows is enough to place them: a group that is
    too small for it is small enough for one bucket.  (The hash reads the weights too: with the same
    columns this branch reuses the exchange that counted the values.)
    """
    if not text:
        shares = [i / BUCKETS for i in range(1, BUCKETS)]
        chosen = F.pmod(F.xxhash64(F.col("_by").cast("double"), *weights), F.lit(SAMPLED)) == 0
        return marked.where(chosen).groupBy("_all", *keys).agg(
            F.array_distinct(F.percentile_approx(F.col("_by").cast("double"), shares, 1000)).alias("_cuts")
        )
    # text has no approximate quantiles: a hashed sample of known expected size stands for the group
    sizes = marked.groupBy("_all", *keys).agg(F.count("*").alias("_n"))
    drawn = F.pmod(F.xxhash64("_by"), F.lit(1 << 30)) * F.col("_n") < F.lit(BUCKETS << 30)
    joined = marked.alias("m").join(sizes.alias("s"), _same("m", "s", keys)).where(drawn)
    own = [F.col(f"m.`{c}`") for c in ("_all", *keys)]
    return joined.groupBy(*own).agg(F.array_sort(F.collect_set(F.col("m._by"))).alias("_cuts"))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    by: Column,
    weights: Sequence[str],
    text: bool = False,
) -> DataFrame:
    """Add ``<w>_before`` (sum over earlier rows of the group) and ``<w>_total`` for every weight.

    ``by`` must not decrease along ``order``: a number or, with ``text``, a string.
    """
    normal = {}
    for i, key in enumerate(keys):
        normal[f"_k{i}"], normal[f"_n{i}"] = _never_null(key, df.schema[key].dataType)
    ids = list(normal)
    marked = df.withColumns({"_all": F.lit(0), "_by": by, **normal})
    cuts = _cuts(marked, ids, text, weights)
    if not keys:
        cuts = F.broadcast(cuts)  # one row
    value = F.col("m._by") if text else F.col("m._by").cast("double")
    # how many cut points are below the value: a binary search by falling steps
    bucket = F.aggregate(
        F.array(*[F.lit(step) for step in SEARCH]),
        F.lit(0),
        lambda at, step: at + F.when(F.get("c._cuts", at + step - 1) < value, step).otherwise(0),
    )
    placed = marked.alias("m").join(cuts.alias("c"), _same("m", "c", ids), "left").select(
        *[F.col(f"m.`{c}`") for c in (*df.columns, *ids)], F.coalesce(bucket, F.lit(0)).alias("_bucket")
    )
    earlier = W.partitionBy(*ids).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(*ids)
    starts = placed.groupBy(*ids, "_bucket").agg(*[F.sum(w).alias(w) for w in weights]).select(
        *ids,
        "_bucket",
        *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"_{w}_start") for w in weights],
        *[F.sum(w).over(everything).alias(f"_{w}_all") for w in weights],
    )
    # the window and the join have the same keys: rows move once
    inside = W.partitionBy(*ids, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = placed.select("*", *[F.coalesce(F.sum(w).over(inside), F.lit(0)).alias(f"_{w}_inside") for w in weights])
    return summed.join(starts, [*ids, "_bucket"]).select(
        *df.columns,
        *[(F.col(f"_{w}_start") + F.col(f"_{w}_inside")).alias(f"{w}_before") for w in weights],
        *[F.col(f"_{w}_all").alias(f"{w}_total") for w in weights],
    )


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], by: Column, text: bool = False
) -> DataFrame:
    """Add ``position`` (0-based place of the row in its group) and ``group_size``."""
    placed = running_totals(df.withColumn("_one", F.lit(1)), keys, order, by, ["_one"], text)
    return placed.select(
        *df.columns,
        F.col("_one_before").alias("position"),
        F.col("_one_total").alias("group_size"),
    )


def long_form(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per (row, numeric column): keys, ``feature``, ``value`` as double."""
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), list(columns), "feature", "value"
    )


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct present values per group with their number ``n``."""
    return (
        df.where(present(F.col(value)))
        .groupBy(*keys, F.col(value).cast("double").alias(value))
        .agg(F.count("*").alias("n"))
    )


def quantile_parts(
    value: Column, n: Column, before: Column, total: Column, probabilities: dict[str, float]
) -> tuple[list[Column], list[Column]]:
    """Aggregates over placed counts, and the interpolated quantiles to select from them."""

    def value_at(place: Column) -> Column:
        return F.max(F.when((before <= place) & (place < before + n), value))

    aggregates, results = [], []
    for name, probability in probabilities.items():
        place = (total - 1) * F.lit(float(probability))
        aggregates += [
            value_at(F.floor(place)).alias(f"_{name}_low"),
            value_at(F.ceil(place)).alias(f"_{name}_high"),
            F.max(place - F.floor(place)).alias(f"_{name}_part"),
        ]
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        results.append((low + (high - low) * F.col(f"_{name}_part")).alias(name))
    return aggregates, results


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Quantiles with linear interpolation: one row per group, one column per probability."""
    placed = running_totals(
        value_counts(df, keys, value), keys, [value], F.col(value), ["n"]
    )
    aggregates, results = quantile_parts(
        F.col(value), F.col("n"), F.col("n_before"), F.col("n_total"), probabilities
    )
    return placed.groupBy(*keys).agg(*aggregates).select(*keys, *results)


def class_counts(
    df: DataFrame, keys: Sequence[str], score: str, label: str, digits: int | None = None
) -> DataFrame:
    """Distinct scores per group with their ``positives`` and ``negatives``.

    ``digits`` rounds scores first, to bound the number of distinct ones.
    """
    value = F.col(score).cast("double")
    value = value if digits is None else F.round(value, digits)
    return (
        df.where(present(F.col(score)) & F.col(label).isNotNull())
        .groupBy(*keys, value.alias(score))
        .agg(
            F.count_if(F.col(label) == 1).alias("positives"),
            F.count_if(F.col(label) != 1).alias("negatives"),
        )
    )


def place_classes(counts: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Class counts with the number of each class below them."""
    return running_totals(
        counts, keys, [score], F.col(score), ["positives", "negatives"]
    )


def auc_aggregate() -> Column:
    """AUC over placed class counts, ties counted half; NULL when only one class occurs."""
    won = F.col("positives").cast("double") * (F.col("negatives_before") + F.col("negatives") / 2)
    pairs = F.max("positives_total").cast("double") * F.max("negatives_total")
    return F.try_divide(F.sum(won), pairs)


def roc_auc(
    df: DataFrame, keys: Sequence[str], score: str, label: str, digits: int | None = None
) -> DataFrame:
    """Area under the ROC curve per group."""
    placed = place_classes(class_counts(df, keys, score, label, digits), keys, score)
    return placed.groupBy(*keys).agg(auc_aggregate().alias("auc"))


def ks_statistic(df: DataFrame, keys: Sequence[str], score: str, in_second: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance between rows with ``in_second`` false and true."""
    counted = (
        df.where(present(F.col(score)))
        .groupBy(*keys, F.col(score).cast("double").alias("_score"))
        .agg(
            F.sum(F.when(F.col(in_second), 0).otherwise(1)).alias("first"),
            F.sum(F.when(F.col(in_second), 1).otherwise(0)).alias("second"),
        )
    )
    placed = running_totals(
        counted, keys, ["_score"], F.col("_score"), ["first", "second"]
    )
    gap = F.abs(
        F.try_divide(F.col("first_before") + F.col("first"), F.col("first_total"))
        - F.try_divide(F.col("second_before") + F.col("second"), F.col("second_total"))
    )
    return placed.groupBy(*keys).agg(
        F.max(gap).alias("ks_statistic"),
        F.max("first_total").alias("first_size"),
        F.max("second_total").alias("second_size"),
    )


def ks_tail_probability(statistic: Column, first_size: Column, second_size: Column) -> Column:
    """Asymptotic p-value of the two-sample distance, ``2 sum (-1)^(k-1) exp(-2 k^2 x^2)``."""
    square = statistic * statistic * first_size * second_size / (first_size + second_size)
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * square),
    )
    series = 2 * F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    return F.when(square < 0.04, F.lit(1.0)).otherwise(clip_unit(series))


def clip_unit(c: Column) -> Column:
    return F.when(c < 0, F.lit(0.0)).when(c > 1, F.lit(1.0)).otherwise(c)
