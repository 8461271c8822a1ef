"""Merkle manifest of a dataset by nested intervals of leaf ranks.

Every row is a leaf: the digest of its fields.  Leaves are ranked inside their group (the language), and a
node covers an interval ``[lo, hi)`` of ranks: ``FANOUT`` consecutive nodes of a level become one node of the
next, until a group has one node, its subroot.  The subroots, in order of their groups, form a tree in the
same way; its top is the root.

* Upwards, the nodes of a level are aggregated by (group, ``lo`` div width of the level): at most ``FANOUT``
  rows meet in one place, however many rows a group has.
* Downwards, a node finds its parent by a containment join: nodes and parents share the bucket of the
  parent's level, and the parent's interval contains the node's.  The siblings are the interval difference
  in the parent: children that end before the node begins are on its left, those that begin after it ends
  are on its right.  A level has an eighth of the rows below it, so all joins together move about a seventh of
  the leaves; the leaves themselves stay in the row of their run until the proofs are made.

Defined cases: a null field is ``-``, an empty one ``0:``; null groups come first, null keys first in their
group; rows with equal keys are ordered by their leaf, so equal rows are interchangeable; a group of one row
is its own subroot, one group alone its own root; an empty table gives no rows; columns other than the
hashed ones do not count.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table
from .ranks import ranked

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**replaced: Column) -> Column:
    """The digest of a row; fields may be replaced by other expressions."""
    return digest(F.concat(*[field(replaced.get(name, F.col(name))) for name in FIELDS]))


def levels(base: DataFrame) -> list[DataFrame]:
    """``g, n, lo, hi, digest, children`` of every level; level 0 is ``base`` (``g, n, lo, hi, digest, row``)."""
    most = base.agg(F.max("n")).first()[0] or 0
    found, width = [base], 1
    while width < most:
        below = found[-1].where(F.col("n") > width)  # groups of one node are done
        width *= FANOUT
        kept = ["lo", "hi", "digest"] + ["row"] * (len(found) == 1)
        runs = below.groupBy("g", "n", F.expr(f"lo div {width}").alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct(*kept)), lambda a, b: (a["lo"] - b["lo"]).cast("int")).alias("children")
        )
        runs = runs.select(
            "g", "n",
            F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
            digest(F.array_join("children.digest", "")).alias("digest"), "children",
        )
        found.append(staged(runs, f"merkle-level-{len(found)}"))
    return found


def tops(found: list[DataFrame]) -> DataFrame:
    """``g, digest``: the one node that a group ends in."""
    ends = []
    for level, nodes in enumerate(found):
        low = FANOUT ** (level - 1) if level else 0
        ends.append(nodes.where((F.col("n") > low) & (F.col("n") <= FANOUT**level)).select("g", "digest"))
    out = ends[0]
    for more in ends[1:]:
        out = out.unionAll(more)
    return out


def _siblings(children: Column, lo: Column, hi: Column) -> Column:
    """Interval difference in a parent: the digests on the left and on the right of ``[lo, hi)``."""
    left = F.filter(children, lambda c: c["hi"] <= lo)
    right = F.filter(children, lambda c: c["lo"] >= hi)
    joined = [F.array_join(F.transform(side, lambda c: c["digest"]), "") for side in (left, right)]
    return F.struct(joined[0].alias("left"), joined[1].alias("right"))


def attached(found: list[DataFrame], above: DataFrame) -> DataFrame:
    """``g, digest, row, path`` of every leaf and the columns of ``above`` (``g``, ``path`` from the top on, more).

    ``path`` lists the siblings on the way up, the nearest first.
    """
    more = [c for c in above.columns if c not in ("g", "path")]
    parents = None
    for level in range(len(found) - 1, 0, -1):
        width = FANOUT**level
        low = width // FANOUT
        nodes = found[level]
        ends = nodes.where((F.col("n") > low) & (F.col("n") <= width)).join(above, "g")
        here = ends.select("g", "lo", "hi", "children", "path", *more)
        if parents is not None:
            up = parents.select(
                F.col("g").alias("_g"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("children").alias("_children"),
                F.col("path").alias("_path"), F.expr(f"lo div {width * FANOUT}").alias("_bucket"), *more,
            )
            inside = (
                (F.col("g") == F.col("_g")) & (F.expr(f"lo div {width * FANOUT}") == F.col("_bucket"))
                & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
            )
            beside = _siblings(F.col("_children"), F.col("lo"), F.col("hi"))
            path = F.concat(F.array(beside), F.col("_path")).alias("path")
            here = here.unionByName(nodes.where(F.col("n") > width).join(up, inside).select("g", "lo", "hi", "children", path, *more))
        parents = staged(here, f"merkle-paths-{level}") if level > 1 else here
    alone = found[0].where("n = 1").join(above, "g").select("g", "digest", "row", "path", *more)
    if parents is None:
        return alone
    held = parents.select("g", "children", F.col("path").alias("_path"), *more, F.explode("children").alias("c"))
    beside = _siblings(F.col("children"), F.col("c.lo"), F.col("c.hi"))
    path = F.concat(F.array(beside), F.col("_path")).alias("path")
    return held.select("g", "c.digest", "c.row", path, *more).unionByName(alone)


def _based(rows: DataFrame) -> DataFrame:
    """Ranked rows as leaves that cover one rank each."""
    lo = F.col("_rank").alias("lo")
    return staged(rows.select("g", F.col("_n").alias("n"), lo, (F.col("_rank") + 1).alias("hi"), "digest", "row"), "merkle-leaves")


def with_proofs(docs: DataFrame, **carried: Column) -> DataFrame:
    """``doc_id, lang, leaf, subroot, root, path`` of every row and the columns ``carried`` from it.

    ``path`` is the membership proof: (left, right) digests of the siblings from the leaf up to the root.
    """
    kept = F.struct("doc_id", "lang", *[c.alias(name) for name, c in carried.items()]).alias("row")
    # the null group sorts before all others, and no group is null
    g = F.coalesce(F.concat(F.lit("l"), F.col("lang").cast("string")), F.lit("")).alias("g")
    leaves = staged(docs.select(g, leaf().alias("digest"), kept), "merkle-digests")
    # equal rows are told apart by their place in the staged files, so that they may be cut into slices
    leaves = leaves.withColumn("_tie", F.monotonically_increasing_id())
    order = [F.col("row.doc_id").asc_nulls_first(), "digest", "_tie"]
    found = levels(_based(ranked(leaves, "g", order)))
    groups = tops(found).select(F.lit("").alias("all"), F.col("g").alias("name"), F.col("digest"))
    upper = ranked(groups, "all", ["name"]).withColumns({"g": F.col("all"), "row": F.struct("name")})
    over = levels(_based(upper))
    none = F.array().cast("array<struct<left: string, right: string>>").alias("path")
    above = attached(over, tops(over).select("g", F.col("digest").alias("root"), none))
    above = above.select(F.col("row.name").alias("g"), F.col("digest").alias("subroot"), "root", "path")
    return attached(found, staged(above, "merkle-subroots")).select(
        "row.doc_id", "row.lang", F.col("digest").alias("leaf"), "subroot", "root", "path", *[f"row.{name}" for name in carried]
    )


def nodes(docs: DataFrame) -> DataFrame:
    """The manifest: ``lang, level, lo, hi, digest`` of every node below the subroots, they included."""
    g = F.coalesce(F.concat(F.lit("l"), F.col("lang").cast("string")), F.lit("")).alias("g")
    leaves = staged(docs.select(g, leaf().alias("digest"), F.struct("doc_id").alias("row")), "merkle-digests")
    leaves = leaves.withColumn("_tie", F.monotonically_increasing_id())
    found = levels(_based(ranked(leaves, "g", [F.col("row.doc_id").asc_nulls_first(), "digest", "_tie"])))
    lang = F.when(F.col("g") != "", F.substr("g", F.lit(2))).alias("lang")
    out = None
    for level, rows in enumerate(found):
        rows = rows.select(lang, F.lit(level).alias("level"), "lo", "hi", "digest")
        out = rows if out is None else out.unionAll(rows)
    return out


def proof_digest(path: Column) -> Column:
    """One digest for a proof: all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def op11_merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    docs = table(spark, directory, "documents")
    rows = with_proofs(docs, tampered=F.when(hit, leaf(text=lower)).otherwise(leaf()))
    rows = rows.withColumn("folded_root", folded(F.col("tampered"), F.col("path")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::UBIGINT)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT, 1, 2, 3, 4, 5, 6, 7]), "
    "lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)), 4294967295::UBIGINT)"
)


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text as a SQL expression."""
    return _CRC32.format(text)


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


_HEAD = " || ".join(_field_sql(f"CAST({c} AS VARCHAR)") for c in FIELDS[:-1])
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, sha256({_HEAD} || {_field_sql("text")}) AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({_HEAD} || {_field_sql(_LOWER)})
      ELSE sha256({_HEAD} || {_field_sql("text")}) END AS tampered
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM docs
), nodes AS (
  SELECT 0 AS level, lang, idx, leaf AS h, n FROM leaves
  UNION ALL
  SELECT level + 1, lang, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY level, lang, idx // 8, n
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, idx, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8
  FROM upper WHERE n > 1 GROUP BY level, idx // 8, n
), beside AS (
  SELECT a.level, a.lang, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.level = b.level AND a.lang IS NOT DISTINCT FROM b.lang AND a.idx // 8 = b.idx // 8
  WHERE a.n > 1 GROUP BY a.level, a.lang, a.idx
), above AS (
  SELECT a.level, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM upper a JOIN upper b ON a.level = b.level AND a.idx // 8 = b.idx // 8
  WHERE a.n > 1 GROUP BY a.level, a.idx
), steps AS (
  SELECT f.lang, f.idx AS place, b.level, b.l, b.r FROM leaves f
  JOIN beside b ON f.lang IS NOT DISTINCT FROM b.lang AND b.idx = f.idx // CAST(pow(8, b.level) AS BIGINT)
  UNION ALL
  SELECT f.lang, f.idx, 1000 + a.level, a.l, a.r FROM leaves f
  JOIN subroots s ON f.lang IS NOT DISTINCT FROM s.lang
  JOIN above a ON a.idx = s.idx // CAST(pow(8, a.level) AS BIGINT)
), paths AS (
  SELECT lang, place, list({{'l': l, 'r': r, 'h': ''}} ORDER BY level) AS path, string_agg(l || r, '' ORDER BY level) AS proof
  FROM steps GROUP BY lang, place
), folds AS (
  SELECT f.doc_id, f.leaf, s.subroot, (SELECT h FROM upper WHERE n = 1) AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
    list_reduce(list_prepend({{'l': '', 'r': '', 'h': f.tampered}}, coalesce(p.path, [])),
      lambda a, e: {{'l': '', 'r': '', 'h': sha256(e.l || a.h || e.r)}}).h AS folded_root
  FROM leaves f JOIN subroots s ON f.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM f.lang AND p.place = f.idx
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folds
"""
