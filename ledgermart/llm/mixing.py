"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times.  Within its source a document's
expected copies are prefix-summed along (size, id), one random offset is added, and a copy is emitted
for each whole number that the document's interval crosses.  Sizes ascend along the sum, so each size
range gets its share and the words taken come near the target.

The prefix sum is a rank times a constant.  Ranks come from a range partitioning on (source, size, id):
partitions are even however large a source is, each is sorted, and the offsets of its sources are sums
over one row per (partition, source).  Targets are found by iterating "cap, reshare" with one aggregate
per round over the table of sources.

Defined cases: a null text has size 0; the null source is a source of its own, ordered last; documents of
size 0 take no words; rows that repeat are drawn one by one; an empty table gives no rows; extra columns
are kept by :func:`mixed`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, staged, table, words_of

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix-1"
UNIT = 1 << 30  # a whole copy in fixed point
#: rows of the (partition, source) table up to which it is broadcast; beyond it is joined
MAX_OFFSETS = 100_000


def in_order(df: DataFrame, order: list[Column | str], parts: int) -> DataFrame:
    """Rows staged in the given order with ``_slice`` (ascending ranges) and ``_at`` (row of the slice)."""
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    placed = placed.withColumn("_mid", mid)
    placed = placed.withColumn("_slice", F.shiftright("_mid", 33)).withColumn(
        "_at", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    return staged(placed.drop("_mid"), "ordered")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, target, _num, _den``; ``sizes`` has ``source, source_size``, a row per source.

    The targets share the sum of all sizes by weight; none exceeds ``most`` times its source.  A source's
    documents are expected ``_num / _den`` times.
    """
    # one row per source, not per document, meets in this window
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by_place = F.array(*[F.lit(w) for w in weights])
    ordered = staged(sizes.withColumn("w", F.get(by_place, place % len(weights)).cast("long")), "sources")
    total = ordered.agg(F.sum("source_size")).first()[0] or 0
    cap = most * F.col("source_size")
    # by weight first; then the capped sources leave the round with their caps, until none is above
    left, share = total, ordered.agg(F.sum("w")).first()[0] or 0
    while True:
        capped = F.lit(left).cast("long") * F.col("w") > cap * F.lit(share).cast("long")
        row = ordered.agg(
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~capped, F.col("w"))), F.lit(0)).alias("weights"),
        ).first()
        if (total - row["taken"], row["weights"]) == (left, share):
            break
        left, share = total - row["taken"], row["weights"]
    left, share = F.lit(left).cast("long"), F.lit(share).cast("long")
    return ordered.select(
        "source", "source_size",
        F.when(capped, cap.cast("double")).otherwise(F.coalesce(F.try_divide((left * F.col("w")).cast("double"), share), F.lit(0.0))).alias("target"),
        F.when(capped, cap).otherwise(left * F.col("w")).alias("_num"),
        F.when(capped, F.col("source_size")).otherwise(share * F.col("source_size")).alias("_den"),
    )


def _offset(seed: str) -> Column:
    text = F.concat(F.lit(seed), F.lit("/"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long") * 4


def sampled(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """All rows of ``docs`` (see :func:`sized`) with ``_source_size, _target, _copies``."""
    spark = docs.sparkSession
    order = [F.col("source").asc_nulls_last(), "_size", "doc_id", "_tie"]
    rows = in_order(docs, order, slices(spark))
    places = rows.groupBy("_slice", "source").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n"), F.sum("_size").alias("size")
    )
    places = staged(places, "places")
    targets = source_targets(places.groupBy("source").agg(F.sum("size").alias("source_size")))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("_slice")) - F.col("n")
    over = F.expr("try_mod(_num, _den)")
    whole = F.coalesce(F.expr("(_num - try_mod(_num, _den)) div nullif(_den, 0)"), F.lit(0))
    part = F.coalesce(F.try_divide(over.cast("double"), F.col("_den").cast("double")), F.lit(0.0))
    known = (
        places.withColumn("_before", before).alias("p")
        .join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
        .select(
            "p._slice", "p.source", "p._first", "p._before", "t.source_size", "t.target",
            whole.cast("long").alias("_whole"), F.floor(part * UNIT).cast("long").alias("_part"),
        )
    )
    known = known.withColumn("_u", _offset(seed))
    known = known.select("_slice", F.col("source").alias("_source"), *[c for c in known.columns if c not in ("_slice", "source")])
    if places.count() <= MAX_OFFSETS:
        known = F.broadcast(known)
    joined = rows.alias("r").join(
        known.alias("k"), (F.col("r._slice") == F.col("k._slice")) & F.col("r.source").eqNullSafe(F.col("k._source"))
    )
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    phase = (F.col("_u") + rank.bitwiseAND(F.lit(UNIT - 1)) * F.col("_part")).bitwiseAND(F.lit(UNIT - 1))
    copies = F.col("_whole") + F.when(phase + F.col("_part") >= UNIT, 1).otherwise(0)
    return joined.select(
        *[F.col(f"r.`{c}`") for c in docs.columns],
        F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), copies.cast("long").alias("_copies"),
    )


def sized(docs: DataFrame, *kept: Column) -> DataFrame:
    """``doc_id, source, _size, _tie`` of every row, and the columns asked for."""
    size = F.size(words_of(F.col("text"))).cast("long")
    return docs.select("doc_id", "source", size.alias("_size"), F.xxhash64("text").alias("_tie"), *kept)


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: every row as often as it is drawn, with the columns of ``docs``."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    drawn = sampled(sized(docs, whole), seed).where("_copies > 0")
    return drawn.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).select("_row.*")


def op8_mixing(spark: SparkSession, directory: str) -> DataFrame:
    return sampled(sized(table(spark, directory, "documents"))).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


#: capped sources are those with the smallest 3 * size / weight; the first prefix of that order after which
#: nothing is above its cap is the fixed point of "cap, reshare"
ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda x: x <> '')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM docs GROUP BY source)
), prefixes AS (
  SELECT *, row_number() OVER o AS place,
    (SELECT CAST(sum(size) AS BIGINT) FROM sources) - coalesce(sum(3 * size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    (SELECT sum(w) FROM sources) - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS share
  FROM sources WINDOW o AS (ORDER BY 3.0 * size / w, source NULLS LAST)
), cut AS (
  SELECT place, CAST(rest AS BIGINT) AS rest, CAST(share AS BIGINT) AS share FROM prefixes WHERE rest * w <= 3 * size * share
  ORDER BY place LIMIT 1
), targets AS (
  SELECT p.source, p.size AS source_size, p.place < c.place AS capped,
    CASE WHEN p.place < c.place THEN 3 * p.size ELSE c.rest * p.w END AS num,
    CASE WHEN p.place < c.place THEN p.size ELSE c.share * p.size END AS den,
    CASE WHEN p.place < c.place THEN CAST(3 * p.size AS DOUBLE) ELSE CAST(c.rest * p.w AS DOUBLE) / c.share END AS target,
    CAST('0x' || substr(md5('mix-1/' || coalesce('s' || p.source, 'null')), 1, 7) AS BIGINT) * 4 AS u
  FROM prefixes p, cut c
), ranked AS (
  SELECT d.doc_id, d.size, t.*, row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS k,
    CASE WHEN den > 0 THEN CAST(floor(CAST(num % den AS DOUBLE) / den * 1073741824) AS BIGINT) ELSE 0 END AS part,
    CASE WHEN den > 0 THEN num // den ELSE 0 END AS whole
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN (u + (k % 1073741824) * part) % 1073741824 + part >= 1073741824 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranked
"""
