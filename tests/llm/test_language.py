import zlib

import numpy as np

from ledgermart.llm import language as la


def cells_of(text):
    out = np.zeros(la._STARTS[-1], np.uint8)
    la.presence(text.encode(), out)
    return out


def plain_cells(text):
    data = bytes(ord(chr(b).lower()) if chr(b).isalpha() else 32 if b < 128 else b for b in text.encode())
    data = [ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else 32 if b < 128 else b for b in text.encode()]
    out = np.zeros(la._STARTS[-1], np.uint8)
    for order, width, start in zip(la.ORDERS, la.WIDTHS, la._STARTS):
        for i in range(len(data) - order + 1):
            gram = 0
            for b in data[i : i + order]:
                gram = (gram * 257 + b) % 2**32
            out[start + (gram if order == 1 else (gram * 2654435769 % 2**32) >> (33 - width.bit_length()))] = 1
    return out


def test_presence_equals_plain_python(monkeypatch):
    for text in ("", "a", "ab", "Ünïcode Text, 12 x", "abc" * 50):
        assert (cells_of(text) == plain_cells(text)).all()
    monkeypatch.setattr(la, "PIECE", 7)  # long texts are hashed in pieces
    assert (cells_of("some longer text in pieces") == plain_cells("some longer text in pieces")).all()


def test_kernel_is_the_mean_of_normalised_intersections():
    x, y = cells_of("the cat sat"), cells_of("the dog sat")
    want = 0
    for a, b in zip(la._STARTS[:-1], la._STARTS[1:]):
        want += (x[a:b] & y[a:b]).sum() / np.sqrt(float(x[a:b].sum()) * y[a:b].sum()) / len(la.ORDERS)
    assert abs(la.kernel(x[None], y[None])[0, 0] - want) < 1e-6 and abs(la.kernel(x[None], x[None])[0, 0] - 1) < 1e-6


def test_folded_scores_equal_the_regression_on_nystroem_features():
    texts = [f"{w} {i} {w}" for i in range(12) for w in ("hello there", "guten tag", "bonjour ami")]
    names = ["en", "de", "fr"] * 12
    cells = np.array([cells_of(t) for t in texts])
    model = la.fit(cells, names)
    assert [model.languages[k] for k in model.scores(cells).argmax(1)] == names
    assert np.allclose(model.scores(cells).sum(1), 1)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = la.op3_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and sum(r["lang"] == r["lang_pred"] for r in out) >= 0.98 * len(out)


def test_only_the_training_fold_teaches(spark, documents):
    texts = {i: "hello there friend" if i % 2 else "guten tag freund" for i in range(40)}
    docs = documents(list(texts.items())).drop("lang")
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    rows = [(i, "wrong" if fold(i) == 0 else "en" if i % 2 else "de") for i in texts]
    docs = docs.join(spark.createDataFrame([*rows, (None, "wrong")], "doc_id long, lang string"), "doc_id")
    model = la.fitted_model(docs)
    assert model.languages == ["de", "en"]


def test_unknown_texts_empty_tables_and_names(spark, documents, clashing):
    docs = clashing(documents([(1, None), (2, ""), (3, "123 !?"), (4, "東京"), (4, "東京"), (None, "some words")]), "score", "lang_pred", "cells")
    model = la.fitted_model(documents([(i, "some words here") for i in range(10)]))
    rows = la.predicted(docs, model).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows[:3]] == [("und", 0.0)] * 3
    assert all(r["lang_pred"] == "en" for r in rows[3:]) and {r["cells"] for r in rows} == {"own"}
    empty = documents([])
    assert la.predicted(empty, la.fitted_model(empty)).count() == 0
    assert {r["lang_pred"] for r in la.predicted(docs, None).collect()} == {"und"}


def test_every_language_is_learned(spark):
    names = [f"l{k:02d}" for k in range(60)]
    rows = [(k * 40 + i, f"{chr(0x4E00 + 50 * k)}{chr(0x4E07 + 50 * k)} {i}", lang) for k, lang in enumerate(names) for i in range(40 - k // 2)]
    rows += [(5, f"{chr(0x4E00)} again {i}", "l00") for i in range(100)]  # one doc_id, many texts
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = la.fitted_model(docs)
    assert model.languages == names
    texts = spark.createDataFrame([(k, chr(0x4E00 + 50 * k) + chr(0x4E07 + 50 * k)) for k in range(60)], "doc_id long, text string")
    assert all(r["lang_pred"] == names[r["doc_id"]] for r in la.predicted(texts, model).collect())
    few = la.fitted_model(docs, per_language=2)
    assert few.languages == names and len(few.landmarks) == 60
    assert [la.share_of(800, n) for n in (1, 50, 100, 10**6)] == [800, 800, 400, 1]
