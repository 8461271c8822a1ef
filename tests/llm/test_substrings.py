import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermart.llm import substrings as s
from ledgermart.llm.wordhash import word_hashes


def brute(texts, size=s.SIZE):
    words = [(t or "").encode().split() for t in texts]
    times = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if times[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=4, max_size=14), st.integers(1, 3)), min_size=1, max_size=6, unique_by=lambda x: tuple(x[0])))
def test_automaton_counts_and_matching_statistics(segments):
    automaton = s.SuffixAutomaton()
    for words, n in segments:
        automaton.add(words, n)
    automaton.close()
    times = Counter()
    for words, n in segments:
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                times[tuple(words[i:j])] += n
    for longest in (3, 50):
        for words in ([0, 1, 2, 2, 1, 0, 0, 3, 1, 1, 0], *[w for w, _ in segments]):
            for end, (size, count) in enumerate(automaton.matching_statistics(words, longest)):
                fits = [k for k in range(min(end + 1, longest) + 1) if k == 0 or tuple(words[end + 1 - k : end + 1]) in times]
                assert size == max(fits)
                if size:
                    assert count == times[tuple(words[end + 1 - size : end + 1])]


def test_segments_cover_every_window_once_and_equal_windows_share_a_minimizer():
    text = " ".join(random.Random(5).choice("abcdefg") for _ in range(300))
    words = word_hashes(text.encode())
    anchor, first, last = s.cut(words)
    assert first[0] == 0 and last[-1] == len(words) - s.SIZE and (first[1:] == last[:-1] + 1).all()
    assert (last - first < 28).all()
    other = word_hashes(("x y z " + text).encode())
    again, begin, end = s.cut(other)
    where = {w: a for a, b, e in zip(again, begin, end) for w in range(b, e + 1)}
    for a, b, e in zip(anchor, first, last):
        assert all(where[w + 3] == a for w in range(b, e + 1))


def texts_with_repeats():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcde") for _ in range(4))
    passage = " ".join(word() for _ in range(60))
    own = lambda n: " ".join(word() for _ in range(n))
    texts = [own(r.randint(0, 20)) + " " + passage + "\n" + own(r.randint(0, 20)) for _ in range(12)]
    texts += [passage.replace(" ", "  "), own(50), own(50) + " " + own(10), None, "", " \t", "one two " * 40, "é " * 80]
    same = own(100)
    return [*texts, same, same, same[:-5], " ".join(passage.split()[:35]), " ".join(passage.split()[:34]), own(3000) + passage]


@pytest.mark.parametrize("shard", [1000, 2])
def test_equal_to_plain_python(spark, documents, monkeypatch, shard):
    monkeypatch.setattr(s, "SHARD", shard)
    texts = texts_with_repeats()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in s.with_kept(documents(texts), text=False).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_kept_text_spans_repeats_and_names(spark, documents, clashing):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = documents([(1, f"a {passage} b"), (2, f"{passage} c"), (3, "alone"), (5, "twice " * 10), (None, f"{passage} d"), (5, "twice " * 10)])
    rows = {r["doc_id"]: r for r in s.with_kept(docs).where("n_removed > 0").collect()}
    assert rows[1]["kept"] == "a b" and rows[1]["spans"] == [[1, 41]] and rows[None]["kept"] == "d"
    out = s.deduplicated(clashing(docs, "id", "hash", "kept", "marks"))
    assert sorted((str(r["doc_id"]), r["text"], r["kept"]) for r in out.collect())[:2] == [("1", "a b", "own"), ("2", "c", "own")]
    same = documents([(7, passage), (7, passage)])
    assert [r["n_removed"] for r in s.with_kept(same).collect()] == [40, 40]
    assert s.with_kept(documents([])).count() == 0


def test_removed_words_joins_marks():
    marks = [{"first": 3, "mask": 0b101}, {"first": 50, "mask": 1}]
    assert np.flatnonzero(s.removed_words(100, marks)).tolist() == [*range(3, 40), *range(50, 85)]
