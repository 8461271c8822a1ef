"""Substring de-duplication by suffix automata of reference shards.

A word goes if a window of ``size`` consecutive words around it also starts elsewhere, in the same or in
another document.  The corpus is its own reference, so the shards are cut such that no window needs more
than one of them, and documents go to the shard instead of every shard to every document:

1. Each window has a minimizer, the smallest hash of its ``gram``-word runs.  Consecutive windows with
   the same minimizer are one segment; equal windows have equal minimizers, whatever the document.
2. Segments whose minimizer occurs once in the corpus are done.  Of the others each different segment is
   kept once, with the number of its occurrences.
3. The segments of a minimizer are a reference shard: a suffix automaton over their words, whose states
   count occurrences.  (A shard of one segment needs no words: all its states count the same.)  The segments are streamed through it; where the matching statistic reaches
   ``size`` and the state of the last ``size`` words counts two or more, the window is repeated.
4. Marks go back to all occurrences, and each document joins its marks into maximal spans.

A minimizer with more than ``SHARD`` different segments (a passage with many surroundings) would make a
large automaton in one task.  Its windows are counted by their hash instead, with map-side sums: same
result, no group in one place.

Defined cases: a null text has no words; texts shorter than a window keep all; rows that repeat count as
occurrences of each other; rows with the same ``doc_id`` and text get the same result; null ids are kept;
an empty table gives no rows; extra columns are kept by :func:`deduplicated`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table
from .wordhash import gram_hashes, mixed, signed, span_hashes, word_hashes

SIZE = 35
GRAM = 8
SHARD = 1000
NO_ID = -(1 << 63)


def cut(words: np.ndarray, size: int = SIZE, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a text: hash of the minimizer, first and last window."""
    windows = len(words) - size + 1
    if windows < 1:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
    hashes = gram_hashes(words, gram)
    reach = size - gram + 1
    least = np.empty(windows, np.int64)
    for at in range(0, windows, 1 << 16):  # bounded working memory for long texts
        part = hashes[at : at + (1 << 16) + reach - 1]
        seen = np.lib.stride_tricks.sliding_window_view(part, reach)
        least[at : at + len(seen)] = seen.argmin(1) + np.arange(at, at + len(seen))
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.concatenate([first[1:], [windows]]) - 1
    return hashes[least[first]], first, last


class SuffixAutomaton:
    """A generalized suffix automaton over sequences of hashable symbols, with weighted occurrences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, symbol, q: int) -> int:
        """A state for the words that reach ``q`` from ``p`` and are no longer than that."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def add(self, sequence, weight: int) -> None:
        at = 0
        for symbol in sequence:
            known = self.next[at].get(symbol)
            if known is not None:
                at = self._split(at, symbol, known)
            else:
                new, p = self._state(self.length[at] + 1, {}, 0), at
                while p >= 0 and symbol not in self.next[p]:
                    self.next[p][symbol] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, symbol, self.next[p][symbol])
                at = new
            self.count[at] += weight

    def close(self) -> None:
        """Add the occurrences of longer words to their suffixes."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def matching_statistics(self, sequence, longest: int) -> Iterator[tuple[int, int]]:
        """Per symbol: length of the longest match that ends there (at most ``longest``) and its occurrences."""
        at = size = 0
        link, length, moves = self.link, self.length, self.next
        for symbol in sequence:
            while at and symbol not in moves[at]:
                at = link[at]
                size = length[at]
            if symbol in moves[at]:
                at, size = moves[at][symbol], size + 1
            while size > longest or (at and length[link[at]] >= longest):
                if length[link[at]] >= longest:
                    at = link[at]
                    size = length[at]
                else:
                    size = longest
            yield size, self.count[at] if size else 0


def repeated_windows(segments: list[tuple[list[int], int]], size: int = SIZE) -> list[int]:
    """For (words, occurrences) of one shard: a mask of repeated windows for each."""
    if len(segments) == 1:  # every state of its automaton counts the same
        words, weight = segments[0]
        return [(1 << (len(words) - size + 1)) - 1 if weight > 1 else 0]
    automaton = SuffixAutomaton()
    for words, weight in segments:
        automaton.add(words, weight)
    automaton.close()
    masks = []
    for words, _ in segments:
        mask = 0
        for i, (matched, count) in enumerate(automaton.matching_statistics(words, size)):
            if matched == size and count > 1:
                mask |= 1 << (i - size + 1)
        masks.append(mask)
    return masks


def _rows(batches, columns: list[str]):
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns], strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


# a segment's place: first window << 8 | windows - 1
_PLACES = "anchor long, digest long, id long, hash long, place long"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("hash"), "text"
    )


def segments(keyed: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``anchor, digest, id, hash, place``: the segments of all texts."""

    def run(batches):
        for batch in batches:
            ids, hashes, texts = batch.column("id").to_numpy(), batch.column("hash").to_numpy(), batch.column("text")
            found: list[list] = [[], [], [], [], []]
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                words = word_hashes(text.encode()) if text else ()
                if len(words) < size:
                    continue
                anchor, first, last = cut(words, size, gram)
                found[0].append(signed(anchor))
                found[1].append(signed(span_hashes(words, first, last + size)))
                found[2].append(np.full(len(first), ids[i]))
                found[3].append(np.full(len(first), hashes[i]))
                found[4].append((first << 8) | (last - first))
            if found[0]:
                arrays = [pa.array(np.concatenate(v)) for v in found]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "digest", "id", "hash", "place"])

    return keyed.mapInArrow(run, _PLACES)


def _with_words(keyed: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """``anchor, digest, n, words`` of chosen segments, cut out of their documents."""
    per_text = chosen.groupBy("id", "hash").agg(F.collect_list(F.struct("anchor", "digest", "n", "place")).alias("parts"))
    schema = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("words", pa.binary())])

    def run(batches):
        for text, parts in _rows(batches, ["text", "parts"]):
            words = word_hashes((text or "").encode())
            out = []
            for p in parts:
                first, more = p["place"] >> 8, p["place"] & 255
                out.append((p["anchor"], p["digest"], p["n"], words[first : first + more + size].tobytes()))
            yield _batch(out, schema)

    joined = keyed.join(per_text, ["id", "hash"]).dropDuplicates(["id", "hash"]).select("text", "parts")
    return joined.mapInArrow(run, "anchor long, digest long, n long, words binary")


_MASKS = "anchor long, digest long, mask long"


def _by_automata(worded: DataFrame, size: int) -> DataFrame:
    """Masks of repeated windows, one automaton per anchor; at most ``SHARD`` segments each."""
    placed = worded.repartition("anchor").sortWithinPartitions("anchor", "digest")
    schema = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("mask", pa.int64())])

    def run(batches):
        out, group, current = [], [], None

        def closed():
            masks = repeated_windows([(np.frombuffer(w, np.uint64).tolist(), n) for _, n, w in group], size)
            return [(current, digest, mask) for (digest, _, _), mask in zip(group, masks, strict=True)]

        for anchor, digest, n, words in _rows(batches, ["anchor", "digest", "n", "words"]):
            if anchor != current:
                if group:
                    out.extend(closed())
                if len(out) > 10_000:
                    yield _batch(out, schema)
                    out = []
                current, group = anchor, []
            group.append((digest, n, words))
        if group:
            out.extend(closed())
        if out:
            yield _batch(out, schema)

    return placed.mapInArrow(run, _MASKS)


def _by_counts(worded: DataFrame, size: int) -> DataFrame:
    """The same masks for minimizers with many surroundings: windows counted by a 128-bit hash."""

    def run(batches):
        for anchor, digest, n, data in _rows(batches, ["anchor", "digest", "n", "words"]):
            words = np.frombuffer(data, np.uint64)
            high = gram_hashes(words, size)
            low = gram_hashes(mixed(words + np.uint64(1)), size)
            k = len(high)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, v)) for v in (anchor, digest, n)] + [pa.array(signed(v)) for v in (high, low)] + [pa.array(np.arange(k))],
                ["anchor", "digest", "n", "high", "low", "at"],
            )

    rows = worded.mapInArrow(run, "anchor long, digest long, n long, high long, low long, at long")
    often = rows.groupBy("high", "low").agg(F.sum("n").alias("times")).where("times > 1")
    marked = rows.join(often, ["high", "low"])
    return marked.groupBy("anchor", "digest").agg(F.sum(F.expr("shiftleft(1L, cast(at as int))")).alias("mask"))


def marks(keyed: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``id, hash, marks``: per text its repeated windows as (first window, mask)."""
    found = segments(keyed, size, gram)
    twice = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    # staged, so that the join below deals out both sides itself and may split a hot anchor
    twice = staged(twice, "repeated-anchors")
    repeated = staged(found.join(twice, "anchor"), "repeated-segments")
    distinct = repeated.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "hash", "place")).alias("one")
    )
    distinct = staged(distinct, "segments")
    sizes = staged(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")), "shard-sizes")
    shards = staged(distinct.select("anchor", "digest", "n", "one.*").join(sizes, "anchor"), "shards")
    # a shard of one segment: every state of its automaton counts that segment's occurrences
    windows = F.col("place").bitwiseAND(F.lit(255)).cast("int") + 1
    lone = shards.where("k = 1 and n > 1").select("anchor", "digest", (F.call_function("shiftleft", F.lit(1).cast("long"), windows) - 1).alias("mask"))
    few = _by_automata(_with_words(keyed, shards.where((F.col("k") > 1) & (F.col("k") <= SHARD)), size), size)
    many = _by_counts(_with_words(keyed, shards.where(F.col("k") > SHARD), size), size)
    masks = lone.unionByName(few).unionByName(many).where("mask <> 0")
    hit = repeated.join(masks, ["anchor", "digest"])
    return hit.groupBy("id", "hash").agg(
        F.collect_set(F.struct(F.shiftright("place", 8).alias("first"), "mask")).alias("marks")
    )


def removed_words(n: int, found: list | None, size: int = SIZE) -> np.ndarray:
    """Which of ``n`` words are inside a repeated window."""
    steps = np.zeros(n + 1, np.int64)
    for m in found or ():
        first, mask = m["first"], m["mask"]
        while mask:
            low = (mask & -mask).bit_length() - 1
            steps[first + low] += 1
            steps[first + low + size] -= 1
            mask &= mask - 1
    return np.cumsum(steps[:-1]) > 0


def with_kept(docs: DataFrame, size: int = SIZE, text: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, spans`` per row and, if asked for, ``kept`` (text).

    ``spans`` are the maximal removed spans as (first word, end); ``kept`` is the other words, joined by a space.
    """
    keyed = _keyed(docs)
    joined = keyed.join(marks(keyed, size), ["id", "hash"], "left").select("id", "hash", "text", "marks")
    names = ["id", "hash", "n_words", "n_removed", "kept_sha256", "spans"] + ["kept"] * text
    span = pa.list_(pa.list_(pa.int64()))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span] + [pa.string()] * text
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches):
        for batch in batches:
            out = []
            for key, hashed, value, found in _rows([batch], ["id", "hash", "text", "marks"]):
                words = (value or "").encode().split()
                gone = removed_words(len(words), found, size)
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if found else words)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]))).reshape(-1, 2)
                row = (key, hashed, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), edges.tolist())
                out.append((*row, kept.decode()) if text else row)
            if out:
                yield _batch(out, schema)

    kind = "id long, hash long, n_words long, n_removed long, kept_sha256 string, spans array<array<long>>"
    rows = joined.mapInArrow(run, kind + ", kept string" * text)
    return rows.withColumn("doc_id", F.nullif("id", F.lit(NO_ID)))


def deduplicated(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with repeated spans taken out of the texts; a text that loses nothing stays as it is."""
    short = with_kept(docs, size).where("n_removed > 0").dropDuplicates(["id", "hash"])
    short = short.select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), F.col("kept").alias("_kept"))
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64("text").alias("_hash"),
    )
    columns = {c: F.col(f"_row.`{c}`") for c in docs.columns}
    columns["text"] = F.coalesce("_kept", columns["text"])
    return own.join(short, ["_id", "_hash"], "left").select(*[v.alias(c) for c, v in columns.items()])


def op2_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return with_kept(docs, text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
