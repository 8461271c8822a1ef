"""Bronze, silver and gold stores for any number of snapshots in one job per layer.

Each layer is written partitioned by snapshot and read back by the next one, so a layer is
computed once and a re-run replaces exactly the snapshots it covers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import iso_day, month_start
from ..operators.calendar import month_calendar, with_enough_history
from ..operators.features import feature_store_backfill
from ..operators.ledger import label_store, silver_ledger
from ..operators.silver import silver_features
from ..sources import stores
from .lake import Lake

LOANS = "loans"
FEATURE_SOURCES = ("clickstream", "attributes", "financials")


def _snapshots(raw: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of the first-of-month snapshots, of those in the span if one is given."""
    dated = raw.withColumn("snapshot_date", iso_day(F.col("snapshot_date")))
    day = F.col("snapshot_date")
    return stores.within(dated.where(day == month_start(day)), start, end)


def rejected(raw: DataFrame) -> DataFrame:
    """Rows that no snapshot serves, with the reason: an unreadable date, or one inside a month."""
    day = iso_day(F.col("snapshot_date"))
    reason = F.when(day.isNull(), "unreadable date").when(day != month_start(day), "not a first of month")
    return raw.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())


def ingest(spark: SparkSession, lake: Lake, source: str, path: str, start: str, end: str) -> None:
    """Raw file to bronze; feature sources also get their lineage columns."""
    raw = stores.scan_raw(spark, path)
    rejected(raw).write.mode("overwrite").parquet(lake.rejects(source))
    rows = _snapshots(raw, start, end)
    if source != LOANS:
        rows = stores.with_lineage(rows, source)
    stores.write_snapshots(rows, lake.bronze(source), span=(start, end))


def land(
    spark: SparkSession,
    lake: Lake,
    source: str,
    folder: str,
    columns: Sequence[str] | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Raw files of ``folder`` that were not taken in yet to the landed store, each exactly once.

    Rows of all dates are taken in; rows that no snapshot serves go to ``landed_rejects`` with the reason and
    their file, and those of earlier calls stay.  Rows of a date that come in several files add up.
    Both stores have their own progress: a call that ended between them is finished by the next one.
    """
    raw = stores.scan_new_files(spark, folder, columns, files_per_batch)
    rows = _snapshots(raw)
    if source != LOANS:
        rows = stores.with_lineage(rows, source)
    stores.append_new(rows, lake.landed(source), lake.landing_progress(source, "rows"), ("snapshot_date",))
    left = rejected(raw.withColumn("source_file", F.col("_metadata.file_path")))
    stores.append_new(left, lake.landed_rejects(source), lake.landing_progress(source, "rejects"))


def refine(
    spark: SparkSession, lake: Lake, source: str, start: str, end: str, landed: bool = False
) -> None:
    """Bronze, or what landed, to silver."""
    bronze = stores.read_store(spark, lake.landed(source) if landed else lake.bronze(source), start, end)
    silver = silver_ledger(bronze) if source == LOANS else silver_features(source, bronze)
    stores.write_snapshots(silver, lake.silver(source), span=(start, end))


def build_labels(
    spark: SparkSession, lake: Lake, start: str, end: str, dpd: int = 30, mob: int = 6
) -> None:
    """Silver ledger to the label store."""
    silver = stores.read_store(spark, lake.silver(LOANS), start, end)
    stores.write_snapshots(label_store(silver, dpd, mob), lake.labels, span=(start, end))


def build_features(
    spark: SparkSession, lake: Lake, start: str, end: str, months: int = 6, history_start: str | None = None
) -> None:
    """Silver sources to the feature store, for the snapshots with enough history.

    ``history_start`` is the first month with data; it is ``start`` unless given.
    """
    known = month_calendar(spark, history_start or start, end)
    served = stores.within(with_enough_history(known, months), start, end)
    first = served.agg(F.min("snapshot_date")).first()[0]
    if first is None:
        return
    sources = [spark.read.parquet(lake.silver(source)) for source in FEATURE_SOURCES]
    store = feature_store_backfill(*sources, str(first), end, months)
    stores.write_snapshots(store, lake.features, ("feature_snapshot_date",), (str(first), end))


def run_medallion(
    spark: SparkSession,
    lake: Lake,
    raw: Mapping[str, str],
    start: str,
    end: str,
    dpd: int = 30,
    mob: int = 6,
    months: int = 6,
    history_start: str | None = None,
    landed: bool = False,
) -> DataFrame:
    """All layers of all sources; returns rows per source, layer and snapshot.

    With ``landed`` the paths in ``raw`` are folders of files, of which only new ones are read.  Give the span
    of the dates that the new files hold: other dates keep their silver rows.
    """
    for source in (LOANS, *FEATURE_SOURCES):
        if landed:
            land(spark, lake, source, raw[source])
        else:
            ingest(spark, lake, source, raw[source], start, end)
        refine(spark, lake, source, start, end, landed)
    build_labels(spark, lake, start, end, dpd, mob)
    build_features(spark, lake, start, end, months, history_start)
    return medallion_report(spark, lake, start, end, landed)


def medallion_report(
    spark: SparkSession, lake: Lake, start: str, end: str, landed: bool = False
) -> DataFrame:
    """Rows written per layer and snapshot, read from the stores."""
    calendar = month_calendar(spark, start, end).drop("months_since_start")
    found = {f"bronze_{s}": lake.landed(s) if landed else lake.bronze(s) for s in (LOANS, *FEATURE_SOURCES)}
    found |= {f"silver_{s}": lake.silver(s) for s in (LOANS, *FEATURE_SOURCES)}
    found["label_store"] = lake.labels
    parts = [
        stores.backfill_report(
            stores.read_or_empty(spark, path, "snapshot_date date"), calendar
        ).withColumn("store", F.lit(name))
        for name, path in found.items()
    ]
    features = stores.read_or_empty(spark, lake.features, "feature_snapshot_date date")
    dated = features.withColumnRenamed("feature_snapshot_date", "snapshot_date")
    parts.append(
        stores.backfill_report(dated, calendar).withColumn("store", F.lit("feature_store"))
    )
    return stores.union_snapshots(parts)
