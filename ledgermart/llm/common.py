"""What several operators share: table reading, native column helpers, a shared stage folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: a word is a run of characters outside these (space and the ASCII controls TAB to CR)
BLANK = r"[\x20\x09-\x0D]+"
#: shuffle files go when the result of their plan is written, not when the driver's JVM happens to collect its garbage
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def words_of(text: Column, separators: str = BLANK) -> Column:
    """The words of a text as an array; an empty array for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, also inside lambda functions."""
    return F.transform(F.array(value), body)[0]


def row_text(*columns: str) -> Column:
    """128 bits that name a row by its content, for joins back to rows without a unique key."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table under the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: cuts the lineage, frees the shuffles behind it."""
    spark = df.sparkSession
    path, before = stage_path(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def slices(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
