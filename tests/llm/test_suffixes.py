import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermart.llm import suffixes as s


def brute(texts, size=s.SIZE):
    bodies = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + size] for b in bodies for i in range(len(b) - size + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - size + 1):
            if times[b[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), len(s.runs(gone)), hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_suffix_array_equals_sorting(symbols):
    text = [*symbols, 0]
    assert s.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_long_and_periodic_texts():
    rng = random.Random(3)
    for text in ([1] * 300, [2, 1] * 150, [1, 2, 1, 1, 2] * 70, [rng.randrange(1, 5) for _ in range(2000)], [rng.randrange(1, 900) for _ in range(2000)]):
        text = [*text, 0]
        assert s.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab é漢\n", min_size=3, max_size=30), st.integers(1, 2)), min_size=1, max_size=6), st.sampled_from([5, 8, 11]))
def test_repeated_windows_equal_counting(parts, size):
    parts = [(t.encode(), n) for t, n in parts]
    times = Counter()
    for b, n in parts:
        for i in range(len(b) - size + 1):
            times[b[i : i + size]] += n
    got = s.repeated_windows(parts, size)
    for (b, _), flags in zip(parts, got, strict=True):
        assert flags.tolist() == [times[b[i : i + size]] > 1 for i in range(len(b) - size + 1)]


def test_segments_cover_every_window_once(monkeypatch):
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.integers(97, 101, 5000), np.full(2000, 97), rng.integers(97, 101, 3000)]).astype(np.uint8)
    places, whole = s.minimizers(data)
    assert whole.tolist() == [s._gram_hashes(data[i : i + s.SIZE], s.GRAM)[p - i] for i, p in enumerate(places.tolist())]
    monkeypatch.setattr(s, "BLOCK", 700)
    anchor, first, last = s.cut(data)
    assert first[0] == 0 and last[-1] == len(whole) - 1 and (first[1:] == last[:-1] + 1).all() and (last - first < 169).all()
    assert all((whole[a : b + 1] == v).all() for v, a, b in zip(anchor, first, last, strict=True))
    assert all(len({data[i : i + s.SIZE].tobytes() for i in range(a, b + 1)}) == b - a + 1 for a, b in zip(first, last, strict=True))


def texts_of(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéü") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, other = prose(60), prose(80)
    near = prose(300)
    texts = [prose(100), None, "", "x" * 199, "y" * 200, "z" * 900, "漢字" * 120, "ab" * 300, shared, shared]
    texts += [prose(20) + " " + shared + prose(9) for _ in range(5)] + [other[:210] + prose(40), prose(40) + other[:205]]
    texts += [near, near[:700] + "!" + near[700:], near[:900] + " neu " + near[1000:], near, prose(400) + other + prose(30) + other]
    return texts


@pytest.mark.parametrize("shard", [s.SHARD, 1])
def test_operator_equals_brute_force(spark, documents, monkeypatch, shard):
    monkeypatch.setattr(s, "SHARD", shard)
    texts = texts_of(5)
    got = sorted(s.with_kept(documents(texts), text=False).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == brute(texts)


def test_query_on_the_smallest_sample(spark, small_dir, samples):
    got = {r["doc_id"]: tuple(r)[1:] for r in s.op12_suffix_array_dedup(spark, small_dir).collect()}
    assert got == dict(zip(samples, brute(list(samples.values())), strict=True))


def test_repeats_null_ids_empty_table_and_extra_columns(spark, documents, clashing):
    text = "".join(random.Random(1).choice("abc d") for _ in range(260))
    docs = clashing(documents([(1, text), (1, text), (None, text), (None, None), (4, "é" + text[:199])]), "id", "hash", "kept", "n_bytes")
    out = s.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in out.where("text is not null").collect()) == [(0, ""), (1, ""), (1, ""), (4, "é" + text[:199])]
    assert out.where("text is null").count() == 1 and {r["kept"] for r in out.collect()} == {"own"}
    assert s.deduplicated(documents([])).count() == 0
    cut = s.with_kept(documents([(1, "éa" + text), (2, "ea" + text)])).collect()
    assert {bytes(r["kept"]).decode() for r in cut} == {"é", "e"} and all(r["spans"] == [[r["n_bytes"] - 261, r["n_bytes"]]] for r in cut)
