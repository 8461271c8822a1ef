import heapq
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgermart.llm import common, huffman, tokens


def optimal(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    return total


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=60), st.integers(6, 12))
def test_lengths_are_a_full_limited_and_best_code(counts, limit):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, limit).astype(int)
    used = counts > 0
    assert ((lengths > 0) == used).all() and lengths.max() <= limit
    if used.sum() > 1:
        assert sum(2.0**-x for x in lengths[used]) == 1
        free = huffman.code_lengths(counts, 40).astype(int)
        assert (free * counts).sum() == optimal(counts.tolist()) <= (lengths * counts).sum()
        if free.max() <= limit:
            assert (free * counts).sum() == (lengths * counts).sum()
    code = [format(int(c), f"0{n}b") for c, n in zip(huffman.codes(lengths), lengths) if n]
    assert not any(a != b and b.startswith(a) for a in code for b in code) and len(set(code)) == len(code)


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 1000, 70_000])
def test_blocks_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.2, n) - 1) % 5000
    lengths = huffman.code_lengths(np.bincount(ids, minlength=5000))
    data, checkpoints = huffman.encode(ids, lengths, huffman.codes(lengths))
    assert (huffman.decode(data, n, checkpoints, huffman.decoding_table(lengths)) == ids).all()


TEXTS = ["", "plain words, isn't it?  two  spaces\n\n\ttabs", "été 東京 🙂 ''s 'll I'VE", "<|endoftext|> inside <|endoftext|>", " " * 50, "a" * 5000, " lead", "trail ", "a \n b\x1c c\x85 d\xa0 e", "\n x  \u2003 y", "don't  we'll 've"]


@pytest.mark.parametrize("limit", [300_000, 5])
def test_words_give_the_ids_of_the_library(samples, monkeypatch, limit):
    monkeypatch.setattr(tokens, "REMEMBERED", limit)
    monkeypatch.setattr(tokens, "PIECES", limit)
    made = tokens.Encoder(tokens.vocabulary())
    library = Tokenizer.from_file(tokens.vocabulary())
    texts = TEXTS + list(samples.values())
    for text, packed in zip(texts, made.encode(pa.array(texts)).to_pylist(), strict=True):
        assert np.frombuffer(packed, made.kind).tolist() == library.encode(text, add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t'sdlvrea1é!\x1c\u2003東"), max_size=20))
def test_any_white_space_gives_the_ids_of_the_library(text):
    made = tokens.encoder(tokens.vocabulary())
    want = made.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(made.encode(pa.array([text]))[0].as_py(), made.kind).tolist() == [*want, 0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from("  '.a1\n"), max_size=30), max_size=5), st.sampled_from([3, 1 << 18]))
def test_any_characters_give_the_ids_of_the_library(texts, gathered):
    made = tokens.encoder(tokens.vocabulary())
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tokens, "GATHERED", gathered)
        got = made.encode(pa.array(texts, pa.string())).to_pylist()
    want = [[*made.tokenizer.encode(text or "", add_special_tokens=False).ids, 0] for text in texts]
    assert [np.frombuffer(packed, made.kind).tolist() for packed in got] == want


@pytest.mark.parametrize("part", [1, 10, 1 << 20])
def test_parts_hold_every_row_once(monkeypatch, part):
    monkeypatch.setattr(tokens, "PART", part)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(7)), "text": pa.array(["", "abc", None, "x" * 25, "", "y", None], pa.string())})
    parts = list(tokens.parts_of(batch))
    assert pa.Table.from_batches(parts).combine_chunks().equals(pa.Table.from_batches([batch]))
    assert len(parts) == 1 or part < 30
    assert list(tokens.parts_of(batch.slice(0, 0))) == []


@pytest.mark.parametrize("block", [1 << 18, 50])
def test_files_round_trip(spark, documents, monkeypatch, block):
    monkeypatch.setattr(tokens, "BLOCK", block)
    rows = [(i * 3 % 40 - 5, TEXTS[i % len(TEXTS)] + f" {i}") for i in range(40)] + [(7, None), (7, None), (None, "no id")]
    docs = documents(rows)
    library = Tokenizer.from_file(tokens.vocabulary())
    got = sorted(tokens.round_trip(docs, tokens.vocabulary()).collect(), key=lambda r: r["start"])
    want = sorted((i is not None, i or 0, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows)
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got] == [w[:2] for w in want]
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    have = sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key)
    wish = sorted(((i, len(ids), crc(ids)) for i, ids in ((i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows)), key=key)
    assert have == wish


def test_ids_come_back_whole_and_empty_tables_work(spark, documents):
    target = common.stage_path(spark, "ids")
    tokens.write_ids(documents(["a b", "c"]), tokens.vocabulary(), target)
    made = {r["doc_id"]: r["ids"] for r in tokens.read_ids(spark, target).collect()}
    assert made == {0: [64, 275, 0], 1: [66, 0]}
    assert tokens.round_trip(documents([]), tokens.vocabulary()).count() == 0


def test_an_encoder_keeps_nothing_of_the_words_it_has_seen():
    def size():
        return sum(len(v) for v in vars(made).values() if hasattr(v, "__len__"))

    made = tokens.Encoder(tokens.vocabulary())
    before = size()
    made.encode(pa.array([" ".join(f"w{i}x, {i}é" for i in range(5000))]))
    assert size() == before


def test_parts_of_a_word_are_encoded_apart_only_where_the_tokenizer_cuts():
    made = tokens.Encoder(tokens.vocabulary())
    words = ["don't", "x's", "a1b2", "été!!", "naïve\n\nDer", "a€!", "١2", "ß", "ÿ'll", "×=", "a×b", "é́.", "A" * 3000 + "."]
    text = "first " + " ".join(w + e for w in words for e in ("", ",", "###", "\n"))
    want = made.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(made.encode(pa.array([text]))[0].as_py(), made.kind).tolist() == [*want, 0]
