"""Licence scan by canonical digest: whole texts against digests of known licences (native).

A text is normalised (case, copyright lines, equivalent spellings, punctuation and white space), its
SHA-256 is taken and joined with the digests of the known licences.  The known table is joined as it
comes: a small one is broadcast by the optimizer, a large one shuffled; nothing depends on its size.

Defined cases: a null or empty text, or one that is empty after normalising, has a null digest and no
licence; licences with equal digests are all named, in order; rows that repeat are judged each; null ids
are kept; an empty licence table finds nothing; extra columns are kept by :func:`with_license` unless
they carry a result's name, which then is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .license_texts import NOTICES, TEXTS, long_texts

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Patterns on lower-cased text and what takes their place ($1 is the first group).
COPYRIGHT_LINE = r"(?:^|\n)[ \t*#/;-]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*"
SPELLINGS = [
    (r"sub[ -]?licen[cs]", "sublicens"),
    (r"licenc", "licens"),
    (r"(acknowledg|judg)ement", "$1ment"),
    (r"(organ|author|recogn|util|optim|real|initial|maxim|minim|capital|emphas)is(e|i|a)", "$1iz$2"),
    (r"(fav|lab|hon|behavi|col)our", "$1or"),
    (r"non[ -]commercial", "noncommercial"),
    (r"whilst", "while"),
    (r"per[ -]cent", "percent"),
    (r"wilful", "willful"),
    (r"fulfill?", "fulfil"),
    (r"https://", "http://"),
    (r"copyright owner", "copyright holder"),
]
NOT_A_WORD = r"[^0-9a-z\x{80}-\x{10FFFF}]+"


def normalised(text: Column) -> Column:
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT_LINE, "\n")
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.trim(F.regexp_replace(out, NOT_A_WORD, " "))


def digest(text: Column) -> Column:
    return F.sha2(F.nullif(normalised(text), F.lit("")).cast("binary"), 256)


def known_texts(spark: SparkSession) -> DataFrame:
    """``license_id, text``: the licences and notices that come with this package."""
    known = {**TEXTS, **NOTICES, **long_texts()}
    return spark.createDataFrame([*known.items()], "license_id string, text string")


def digests(licenses: DataFrame) -> DataFrame:
    """``digest, license_ids`` of a table ``license_id, text``."""
    rows = licenses.select(digest(F.col("text")).alias("digest"), "license_id").where(F.col("digest").isNotNull())
    return rows.groupBy("digest").agg(F.array_sort(F.collect_set("license_id")).alias("license_ids"))


def with_license(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with ``digest``, ``license_ids`` (null: none), ``is_license``."""
    own = docs.drop("digest", "license_ids", "is_license").withColumn("digest", digest(F.col("text")))
    return own.join(digests(licenses), "digest", "left").select(
        *[F.col(f"`{c}`") for c in own.columns], "license_ids", F.col("license_ids").isNotNull().alias("is_license")
    )


def op6_license_scan(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    found = with_license(docs, known_texts(spark))
    return found.select("doc_id", "digest", F.array_join("license_ids", ",").alias("license_ids"), "is_license")


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_normalised(column: str) -> str:
    sql = f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"
    sql = f"regexp_replace({sql}, {_sql_text(COPYRIGHT_LINE)}, chr(10), 'g')"
    for pattern, replacement in SPELLINGS:
        sql = f"regexp_replace({sql}, {_sql_text(pattern)}, {_sql_text(replacement.replace('$', chr(92)))}, 'g')"
    return f"trim(regexp_replace({sql}, {_sql_text(NOT_A_WORD)}, ' ', 'g'))"


ORACLE_SQL = f"""
WITH known AS (
  SELECT sha256(v) AS digest, string_agg(DISTINCT id, ',' ORDER BY id) AS license_ids
  FROM (SELECT id, {_sql_normalised("text")} AS v FROM (VALUES
    {", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in {**TEXTS, **NOTICES}.items())}) t(id, text))
  WHERE v <> '' GROUP BY 1
), docs AS (SELECT doc_id, nullif({_sql_normalised("text")}, '') AS v FROM documents)
SELECT d.doc_id, sha256(d.v) AS digest, k.license_ids, k.license_ids IS NOT NULL AS is_license
FROM docs d LEFT JOIN known k ON sha256(d.v) = k.digest
"""
