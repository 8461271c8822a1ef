"""Benchmark decontamination: a broadcast set of test n-grams against training windows (native).

The windows of the benchmark (13 words; a shorter item is one window) become a table of distinct
window texts with their items.  Documents are scanned where they are read: every word position looks
up the hash of its first three words in the broadcast table, and a position that hits is verified by
comparing the whole window text.  Only true hits and one row per document leave the scan.

The benchmark is broadcast in parts of at most ``BROADCAST_BYTES`` each, measured before: a benchmark
of any size is handled by as many passes over the documents as it has parts.

Defined cases: a null text has no words and is never hit; an item without words has no window; an item
that repeats (same ``item_id``) counts once; rows that repeat are judged each; null ids are kept; extra
columns are kept by :func:`decontaminated`, columns named like results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table, words_of

#: everything that is no ASCII digit, ASCII small letter or non-ASCII character, after lower-casing A-Z
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
ANCHOR = 3
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal_words(text: Column) -> Column:
    return words_of(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS)


def _anchor(words: Column, i: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(words, i + k) for k in range(length)])


def test_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``window`` (words joined by a space), ``len``, ``anchor``, ``items``: the distinct windows."""
    items = benchmark.select("item_id", normal_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    rows = items.select("item_id", "w", F.explode(starts).alias("i")).select(
        "item_id", F.slice("w", F.col("i") + 1, size).alias("w")
    )
    anchors = F.coalesce(*[F.when(F.size("w") >= n, _anchor(F.col("w"), F.lit(0), n)) for n in range(ANCHOR, 0, -1)])
    return (
        rows.groupBy("w")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .select(F.array_join("w", " ").alias("window"), F.size("w").alias("len"), anchors.alias("anchor"), "items")
    )


def _parts(windows: DataFrame, limit: int) -> tuple[list[int], int]:
    """The anchor lengths in use (at most ``ANCHOR`` numbers), and how many broadcasts it takes."""
    size = F.length("window") + 8 * F.size("items") + 64
    row = windows.agg(F.sum(size).alias("b"), F.collect_set(F.least("len", F.lit(ANCHOR))).alias("n")).first()
    return sorted(row["n"]), -(-(row["b"] or 0) // limit)


def hits(docs: DataFrame, windows: DataFrame, carry: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document row: ``rid``, ``row``, ``n_words``, ``spans``, ``items``.

    ``row`` holds the columns of ``docs`` named by ``carry``; ``spans`` is an array of (first word,
    words) of the occurrences; ``items`` holds distinct item ids.
    """
    lengths, parts = _parts(windows, limit)
    # word 0 is a marker that no window holds: its row stands for the document
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.concat(F.array(F.lit("")), normal_words(F.col("text"))).alias("w"),
    )
    rows = base.select("rid", "row", "w", F.posexplode("w").alias("i", "_"))
    keys = [_anchor(F.col("w"), F.col("i"), n) for n in lengths]
    first = F.col("i") == 0
    found = []
    for part in range(max(parts, 1)):
        mine = windows if parts <= 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)
        key = F.explode(F.array(*keys)) if len(keys) > 1 else keys[0] if keys else F.lit(0).cast("long")
        looked = rows.withColumn("key", key)
        text = F.array_join(F.slice("w", F.col("i") + 1, F.col("len")), " ")
        joined = looked.join(F.broadcast(mine), (F.col("key") == F.col("anchor")) & (F.col("window") == text), "left")
        marker = first & F.lit(part == 0)
        found.append(
            joined.where(F.col("window").isNotNull() | marker).select(
                "rid",
                F.when(marker, F.col("row")).alias("row"),
                F.when(marker, F.size("w") - 1).alias("n_words"),
                F.when(F.col("window").isNotNull(), F.struct((F.col("i") - 1).alias("at"), F.col("len"))).alias("span"),
                "items",
            )
        )
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out.groupBy("rid").agg(
        F.first("row", ignorenulls=True).alias("row"),
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )


def covered(spans: Column) -> Column:
    """How many words a sorted array of (at, len) covers."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def step(a: Column, s: Column) -> Column:
        end = s["at"] + s["len"]
        return F.struct(
            (a["n"] + F.greatest(end - F.greatest(s["at"], a["end"]), F.lit(0))).alias("n"), F.greatest(a["end"], end).alias("end")
        )

    return F.aggregate(spans, start, step, lambda a: a["n"])


def judged(
    docs: DataFrame, benchmark: DataFrame, carry: list[str], size: int = WINDOW, share: int = 20
) -> DataFrame:
    """``row``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``spans``.

    A document is contaminated if at least one of ``share`` words is inside a test window.
    """
    out = hits(docs, test_windows(benchmark, size), carry).withColumn("n_hit", covered(F.col("spans")))
    ids = F.array_sort(F.transform("items", lambda i: F.coalesce(i.cast("string"), F.lit("null"))))
    return out.select(
        "row", "n_words", "n_hit", "spans",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def _without(words: Column, spans: Column) -> Column:
    inside = F.array_distinct(
        F.flatten(F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["len"] - 1)))
    )
    return let(inside, lambda hit: F.filter(words, lambda _, i: ~F.array_contains(hit, i)))


def decontaminated(docs: DataFrame, benchmark: DataFrame, mode: str = "document") -> DataFrame:
    """``docs`` without contaminated documents, or (``mode="span"``) with hit words taken out of all.

    In span mode the text of a document with hits becomes its other normalised words, joined by a
    space; a document without hits keeps its text.
    """
    if mode not in ("document", "span"):
        raise ValueError(f"mode is document or span, not {mode!r}")
    out = judged(docs, benchmark, docs.columns)
    if mode == "document":
        return out.where(~F.col("contaminated")).select("row.*")
    text = F.when(F.col("n_hit") > 0, F.array_join(_without(normal_words(F.col("row.text")), F.col("spans")), " "))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    columns["text"] = F.coalesce(text, columns["text"])
    return out.select(*[column.alias(name) for name, column in columns.items()])


def op10_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    out = judged(docs, table(spark, directory, "benchmark"), ["doc_id"])
    return out.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS v
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows
), starts AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS v
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)
), found AS (SELECT s.doc_id, s.n, s.i, t.item_id FROM starts s JOIN windows t ON s.v = t.v AND s.n = t.n
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
  sha256(coalesce(m.ids, '')) AS items_sha256,
  coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN places p USING (doc_id) LEFT JOIN named m USING (doc_id)
"""
