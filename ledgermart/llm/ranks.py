"""Ranks of rows inside their group, however large one group is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged
from .mixing import MAX_OFFSETS, in_order


def ranked(df: DataFrame, group: str, order: list[Column | str]) -> DataFrame:
    """Rows with ``_rank`` (from 0, by ``order`` inside ``group``) and ``_n``, the rows of the group.

    Rows are range-partitioned on (group, order), so a hot group is many slices; ranks are the place in
    the slice plus the sums of one row per (slice, group).
    """
    rows = in_order(df, [F.col(group).asc_nulls_first(), *order], slices(df.sparkSession))
    places = rows.groupBy("_slice", group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    places = staged(places, "places")
    whole = Window.partitionBy(group)
    before = F.sum("_rows").over(whole.orderBy("_slice")) - F.col("_rows")
    known = places.select(
        F.col("_slice").alias("_of"), F.col(group).alias("_group"),
        (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("_n"),
    )
    if places.count() <= MAX_OFFSETS:
        known = F.broadcast(known)
    joined = rows.join(known, (F.col("_slice") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("_rank", F.col("_at") + F.col("_shift")).drop("_slice", "_at", "_of", "_group", "_shift")
