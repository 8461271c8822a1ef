import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgermart.llm import merkle as m

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h(*parts)


def climb(digests):
    """Top of a run of digests, and the siblings of each on the way up."""
    paths = [[] for _ in digests]
    groups = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, members = [], []
        for at in range(0, len(digests), 8):
            run = digests[at : at + 8]
            for k, of in enumerate(groups[at : at + 8]):
                for i in of:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            members.append([i for of in groups[at : at + 8] for i in of])
        digests, groups = above, members
    return digests[0], paths


def brute(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    tops = []
    for lang in langs:
        group = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        tops.append((group, *climb([plain_leaf(*r) for r in group])))
    root, over = climb([t[1] for t in tops])
    out = []
    for (group, subroot, paths), upper in zip(tops, over):
        for r, path in zip(group, paths):
            way, text = path + upper, r[1]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if hit else text
            at = plain_leaf(r[0], lowered, *r[2:])
            for left, right in way:
                at = h(left, at, right)
            out.append((r[0], plain_leaf(*r), subroot, root, h(*[x + y for x, y in way]), at, at == root))
    return sorted(out, key=repr)


def rows_of(n):
    kinds = ["de", None, "é", "en", "en", "en"]
    rows = [(i * 7 % 1000, [f"Text {i}", None, "", "lower ÄB"][i % 4], kinds[i % 6], [None, "s"][i % 2], [None, i][i % 3 > 0]) for i in range(n)]
    return rows + [(5, "alone", "xx", "s", 1), (None, "no id", "en", "s", 2), (7, "A", "en", "s", 1), (7, "A", "en", "s", 1), (7, "B", "en", "s", 1)]


@pytest.mark.parametrize("n", [0, 70, 400])
def test_manifest_equals_brute_force(spark, tmp_path, n):
    rows = rows_of(n)
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in m.op11_merkle_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_one_row_one_language_and_an_empty_table(spark):
    one = m.with_proofs(spark.createDataFrame([(1, "a", "en", "s", 1)], DOCUMENTS)).collect()
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] and one[0]["path"] == []
    assert m.with_proofs(spark.createDataFrame([], DOCUMENTS)).count() == 0
    assert m.nodes(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_nodes_nest_and_extra_columns_do_not_count(spark, clashing):
    docs = spark.createDataFrame(rows_of(150), DOCUMENTS)
    found = m.nodes(docs).collect()
    spans = {(r["lang"], r["level"], r["lo"], r["hi"]): r["digest"] for r in found}
    for (lang, level, lo, hi), value in spans.items():
        inside = sorted((k[2], d) for k, d in spans.items() if k[0] == lang and k[1] == level - 1 and lo <= k[2] < hi)
        assert level == 0 or value == h(*[d for _, d in inside])
    other = clashing(docs, "digest", "path", "row", "g", "_rank", "lo", "n", "root")
    pick = lambda df: sorted(tuple(r) for r in df.select("leaf", "root").collect())
    assert pick(m.with_proofs(docs)) == pick(m.with_proofs(other))


def test_carried_columns(spark):
    docs = spark.createDataFrame(rows_of(20), DOCUMENTS)
    got = m.with_proofs(docs, size=F.length("text")).where("doc_id = 5 and lang = 'xx'").collect()
    assert got[0]["size"] == 5
