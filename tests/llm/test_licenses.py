from ledgermart.llm import licenses as li
from ledgermart.llm.license_texts import TEXTS


def found(docs, known):
    return {r["doc_id"]: r["license_ids"] for r in li.with_license(docs, known).collect()}


def test_variants_of_a_licence_have_its_digest(spark, documents):
    mit = TEXTS["MIT"]
    variants = [
        mit,
        mit.upper(),
        mit.replace("<year> <holders>", "2019-2024 Jane Doe and others"),
        "/*\n * " + mit.replace("\n", "\n * ") + "\n */",
        mit.replace("sublicense", "sub-licence").replace('"', "'"),
        mit.replace("\n", "\r\n").replace(" ", "  "),
        mit + "one more word",
        mit[:-20],
        "Released under the MIT License.",
        None, "", " .;\n", "Copyright 2020 Somebody",
    ]
    got = found(documents(variants), li.known_texts(spark))
    assert [got[i] for i in range(6)] == [["MIT"]] * 6
    assert [got[i] for i in (6, 7)] == [None] * 2 and got[8] == ["MIT-notice"]
    assert [got[i] for i in range(9, 13)] == [None] * 4


def test_equal_digests_empty_tables_repeats_and_names(spark, documents, clashing):
    known = spark.createDataFrame([("b", "Some  text"), ("a", "some text!"), ("a", "some text"), ("c", None)], "license_id string, text string")
    docs = clashing(documents([(1, "SOME TEXT"), (1, "SOME TEXT"), (None, "some text")]), "digest", "is_license", "v")
    rows = li.with_license(docs, known).collect()
    assert [r["license_ids"] for r in rows] == [["a", "b"]] * 3 and {r["v"] for r in rows} == {"own"}
    assert found(documents([]), known) == {}
    assert found(documents(["some text"]), known.limit(0)) == {0: None}


def test_every_built_in_text_finds_itself(spark, documents):
    got = found(documents(list(TEXTS.values())), li.known_texts(spark))
    assert all(name in got[i] for i, name in enumerate(TEXTS))


def test_long_texts_are_known(spark, documents):
    from ledgermart.llm.license_texts import long_texts

    texts = long_texts()
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"} <= texts.keys()
    rows = [v for t in texts.values() for v in (t, "/*\n * " + t.upper().replace("\n", "\n * ") + "\n */", t[: len(t) // 2])]
    got = found(documents(rows), li.known_texts(spark))
    assert all([got[3 * i], got[3 * i + 1], got[3 * i + 2]] == [[name], [name], None] for i, name in enumerate(texts))
