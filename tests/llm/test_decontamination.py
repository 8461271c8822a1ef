import hashlib
import re
import string

from ledgermart.llm import decontamination as d

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SEPARATORS = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return [w for w in SEPARATORS.split((text or "").translate(LOWER)) if w]


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(item)
    out = {}
    for key, text in texts.items():
        w, hit, found = words(text), set(), set()
        for window, of in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= of
        ids = ",".join(sorted(map(str, found)))
        n = len(hit)
        out[key] = (len(w), n, len(found), hashlib.sha256(ids.encode()).hexdigest(), n > 0 and 20 * n >= len(w))
    return out


PASSAGE = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen."
ITEMS = [(1, PASSAGE), (10, PASSAGE), (2, "Short, item"), (3, "É1"), (4, ""), (5, None), (6, "a b a"), (2, "Short, item")]
TEXTS = {
    0: "intro " + PASSAGE + " outro", 1: "one two three four five six seven eight nine ten eleven twelve", 2: None, 3: "",
    4: "short-ITEM é1 É1 a b a b a", 5: "x " * 5000 + PASSAGE, 6: "...", 7: PASSAGE[:70] + " " + PASSAGE, 8: "a b",
}


def results(frame):
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return {r["row"]["doc_id"]: tuple(r[c] for c in names) for r in frame.collect()}


def test_equal_to_plain_python(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(list(TEXTS.items()))
    assert results(d.judged(docs, items, ["doc_id"])) == brute(TEXTS, ITEMS)


def test_a_benchmark_in_several_broadcasts_gives_the_same(spark, documents, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(list(TEXTS.items()))
    whole = d.hits(docs, d.test_windows(items), ["doc_id"])
    parts = d.hits(docs, d.test_windows(items), ["doc_id"], limit=300)
    plain = lambda f: sorted((r["row"]["doc_id"], r["n_words"], str(r["spans"]), sorted(r["items"])) for r in f.collect())
    assert plain(whole) == plain(parts)


def test_documents_and_spans_are_removed(spark, documents, clashing):
    items = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    docs = clashing(documents(list(TEXTS.items())), "n_hit", "w", "row", "rid", "len", "items")
    kept = d.decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 8]
    spans = {r["doc_id"]: r["text"] for r in d.decontaminated(docs, items, "span").collect()}
    assert spans[0] == "intro outro" and spans[1] == TEXTS[1] and spans[2] is None and spans[5] == " ".join(["x"] * 5000)


def test_empty_tables_and_repeats(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents([(1, PASSAGE), (1, PASSAGE), (None, PASSAGE)])
    assert {r["n_hit"] for r in d.judged(docs, none, ["doc_id"]).collect()} == {0}
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert [r["n_hit"] for r in d.judged(docs, items, ["doc_id"]).collect()] == [14] * 3
    assert d.judged(documents([]), items, ["doc_id"]).count() == 0
