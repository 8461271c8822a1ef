"""Substring de-duplication by suffix arrays of reference shards, on bytes.

A byte goes if a string of ``SIZE`` bytes around it also starts elsewhere, in the same or in another document.

1. Each window of ``SIZE`` bytes has a minimizer, the smallest hash of its ``GRAM``-byte runs.  Equal windows
   have equal minimizers; consecutive windows with their minimizer in one place are a segment.  Segments whose
   minimizer is met once are done; of the others each different one is kept once, with its number of occurrences.
2. The segments of a minimizer go to one task, which builds a suffix array over pieces of whole minimizers.
   Its symbols are words with the blank before them: their edges follow from neighbouring bytes alone, so equal
   windows are cut alike.
3. :func:`suffix_array` sorts in two phases.  First, suffixes are grouped by their Lyndon prefixes: groups are
   taken in descending order; previous-smaller pointers name the suffixes whose Lyndon prefix grows by this
   group's, and these leave their group for a higher one.  Then the order is emitted from the smallest suffix
   on: each suffix that is out lets the chain of pointers before it out.  Nothing is renamed or recursed into.
4. Bytes that neighbours in the array share give, for every window, the interval of suffixes that share the
   rest of it behind its first, cut word: windows are equal if cut word and interval are.  Windows that occur
   more than once are marked, go back to all occurrences of their segments, and become spans.

A minimizer with more than ``SHARD`` different segments would make a large array in one task.  Its windows are
counted by their hash instead, with map-side sums: same result, no group in one place.

Defined cases: a null text has no bytes; texts shorter than a window keep all; rows that repeat count as
occurrences of each other; null ids are kept; very long texts are hashed in blocks; an empty table gives no
rows; extra columns are kept by :func:`deduplicated`, which drops characters that lost some of their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table
from .wordhash import mixed, powers, signed, span_hashes

SIZE = 200
GRAM = 32
SHARD = 4000
BLOCK = 1 << 16
_PLACE = np.uint64((1 << 17) - 1)  # a place in a block and the window behind it
PIECE = 1 << 18
NO_ID = -(1 << 63)
_U = np.uint64
_BASE = 0xD1B54A32D192ED03
_BYTES = mixed(np.arange(1, 257, dtype=_U) * _U(_BASE))  # a 64-bit value for each byte
_END = 0xFF  # between segments; no byte of UTF-8


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """One hash per run of ``gram`` bytes, a power of two."""
    value, k, factor = _BYTES[data], 1, _BASE
    while k < gram:
        value = value[:-k] * _U(factor) + value[k:]
        k, factor = 2 * k, factor * factor % (1 << 64)
    return mixed(value)


def minimizers(data: np.ndarray, size: int = SIZE, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Of every window of a block: the first place of its smallest gram hash, and that hash."""
    hashes, reach, k = _gram_hashes(data, gram), size - gram + 1, 1
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=_U)  # smallest hash, then first place
    while 2 * k <= reach:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    places = (np.minimum(least[: len(least) - (reach - k)], least[reach - k :]) & _PLACE).astype(np.int64)
    return places, hashes[places]


def cut(data: np.ndarray, size: int = SIZE, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a text: minimizer, first and last window.  No two windows of a segment are equal."""
    windows = len(data) - size + 1
    found: list[list[np.ndarray]] = [[np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    for at in range(0, max(windows, 0), BLOCK):
        places, hashes = minimizers(data[at : min(at + BLOCK, windows) + size - 1], size, gram)
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        last = np.concatenate([first[1:], [len(places)]]) - 1
        for to, part in zip(found, (hashes[first], first + at, last + at), strict=True):
            to.append(part)
    return tuple(map(np.concatenate, found))


def suffix_array(text: list[int]) -> list[int]:
    """Suffixes in ascending order; the last symbol is the smallest and occurs once."""
    n = len(text)
    values = np.asarray(text)
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.concatenate([heads, [n]]))
    group_of, place_of = np.empty(n, np.int64), np.empty(n, np.int64)
    group_of[order], place_of[order] = np.repeat(heads, sizes), np.arange(n)
    size_at = np.zeros(n, np.int64)
    size_at[heads] = sizes
    # a group is named by its first place in ``held``
    held, group, place, size = order.tolist(), group_of.tolist(), place_of.tolist(), size_at.tolist()
    smaller = [-1] * n  # nearest suffix to the left in a lower group
    end = n
    while end:
        start = group[held[end - 1]]
        copies: dict[int, int] = {}
        for i in sorted(held[start:end]) if end - start > 1 else (held[start],):
            p = i - 1
            while p >= 0 and group[p] > start:
                p = smaller[p]
            if p >= 0:
                if group[p] == start:
                    p = smaller[p]
                if p >= 0 and size[group[p]] > 1:
                    copies[p] = copies.get(p, 0) + 1
            smaller[i] = p
        # suffixes whose Lyndon prefix grows by this group's go behind the others of their group, once per copy
        grown, times = list(copies), 1
        while grown:
            for p in grown:
                g = group[p]
                size[g] -= 1
                to = g + size[g]
                other, own = held[to], place[p]
                held[to], held[own] = p, other
                place[p], place[other] = to, own
            targets = [group[p] + size[group[p]] for p in grown]  # before sizes of new groups are counted
            for p, to in zip(grown, targets, strict=True):
                group[p] = to
                size[to] += 1
            times += 1
            grown = [p for p in grown if copies[p] >= times]
        end = start
    out, free, placed = [0] * n, list(range(n)), bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for at in range(n):
        s = out[at] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = smaller[s]
    return out


def _shared_bytes(data: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Equal bytes from places ``x`` and ``y`` on, up to ``most`` (a multiple of 8); ``data`` is padded."""
    eights = np.ndarray(len(data) - 7, "<u8", data.tobytes(), strides=(1,))
    shared = np.zeros(len(x), np.int64)
    alive = np.arange(len(x))
    for step in range(0, most, 8):
        differs = eights[x[alive] + step] ^ eights[y[alive] + step]
        ends = differs != 0
        shared[alive] = step + 8
        if ends.any():
            bad = np.ascontiguousarray(differs[ends]).view(np.uint8).reshape(-1, 8) != 0
            shared[alive[ends]] = step + bad.argmax(1)
            alive = alive[~ends]
        if not len(alive):
            break
    return shared


def repeated_windows(segments: list[tuple[bytes, int]], size: int = SIZE) -> list[np.ndarray]:
    """For (bytes, occurrences): which windows of each occur more than once in all of them."""
    joined = b"".join(part for s, _ in segments for part in (s, b"\xff")) + bytes(2 * size + 16)
    data = np.frombuffer(joined, np.uint8)
    lengths = np.array([len(s) for s, _ in segments])
    stops = np.cumsum(lengths + 1)
    n = int(stops[-1])
    body = data[:n]
    # a symbol starts at a blank after another byte, at a three-byte character, at a segment's end and start
    blank = body <= 0x20
    edge = np.concatenate([[True], (blank[1:] & ~blank[:-1]) | (body[1:] >= 0xE0) | (body[:-1] == _END)])
    starts = np.flatnonzero(edge)
    ends = np.concatenate([starts[1:], [n]])
    values = _BYTES[body]
    names = span_hashes(values, starts, ends)
    different, first, symbol = np.unique(names, return_index=True, return_inverse=True)
    spelt = [joined[starts[i] : ends[i]] for i in first]
    order = sorted(range(len(spelt)), key=lambda k: (spelt[k] != b"\xff", spelt[k]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    array = np.array(suffix_array([*rank[symbol].tolist(), 0]))
    begin = np.concatenate([starts, [n]])[array]
    shared = _shared_bytes(data, begin[:-1], begin[1:], -(-size // 8) * 8)
    place = np.empty(len(array), np.int64)
    place[array] = np.arange(len(array))
    # every window: its first, cut symbol and the suffix behind it
    at = np.arange(n)
    token = np.repeat(np.arange(len(starts)), ends - starts)
    segment = np.repeat(np.arange(len(segments)), lengths + 1)
    whole = at + size <= (stops - 1)[segment]
    at, token, segment = at[whole], token[whole], segment[whole]
    if not len(at):
        return [np.zeros(0, bool) for _ in segments]
    head = np.minimum(ends[token] - at, size)
    rest = np.zeros(len(at), np.int64)
    by_head = np.argsort(head, kind="stable")
    heads, counts = np.unique(head, return_counts=True)
    for length, rows in zip(heads.tolist(), np.split(by_head, np.cumsum(counts)[:-1]), strict=True):
        if length < size:
            interval = np.concatenate([[0], np.cumsum(shared < size - length)])
            rest[rows] = interval[place[token[rows] + 1]]
    up, down = powers(n + 1, _BASE)
    total = np.concatenate([np.zeros(1, _U), np.cumsum(values * up[:n])])
    key = mixed((total[at + head] - total[at]) * down[at] + head.astype(_U)) + mixed(rest.astype(_U) + _U(1)) * _U(_BASE)
    _, inverse = np.unique(key, return_inverse=True)
    times = np.bincount(inverse, np.array([w for _, w in segments], float)[segment])
    repeated = times[inverse] > 1
    return np.split(repeated, np.cumsum(np.maximum(lengths - size + 1, 0))[:-1])


def runs(flags: np.ndarray) -> np.ndarray:
    """(first, end) of every run of true flags."""
    return np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]))).reshape(-1, 2)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("hash"),
        F.col("text").cast("binary").alias("body"),
    )


def _bodies(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The texts of a batch as views of its memory."""
    return [np.frombuffer(v.as_buffer(), np.uint8) if v.is_valid and len(v.as_buffer()) else np.zeros(0, np.uint8) for v in batch.column("body")]


def _record(names: list[str], columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


# a segment's place: first window << 8 | windows - 1
_PLACES = "anchor long, digest long, id long, hash long, place long"


def segments(keyed: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``anchor, digest, id, hash, place``: the segments of all texts."""

    def run(batches):
        for batch in batches:
            ids, hashes = batch.column("id").to_numpy(), batch.column("hash").to_numpy()
            found: list[list] = [[], [], [], [], []]
            for i, data in enumerate(_bodies(batch)):
                if len(data) < size:
                    continue
                anchor, first, last = cut(data, size, gram)
                digest = np.empty(len(first), _U)
                for at in range(0, len(first), BLOCK // 64):  # bounded working memory for long texts
                    part = slice(at, at + BLOCK // 64)
                    low, high = first[part][0], last[part][-1] + size
                    digest[part] = span_hashes(_BYTES[data[low:high]], first[part] - low, last[part] + size - low)
                for to, values in zip(found, (signed(anchor), signed(digest), np.full(len(first), ids[i]), np.full(len(first), hashes[i]), (first << 8) | (last - first)), strict=True):
                    to.append(values)
            if found[0]:
                yield _record(["anchor", "digest", "id", "hash", "place"], map(np.concatenate, found))

    return keyed.mapInArrow(run, _PLACES)


def _with_bytes(keyed: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """``anchor, digest, n, bytes`` of chosen segments, cut out of their documents."""
    per_text = chosen.groupBy("id", "hash").agg(F.collect_list(F.struct("anchor", "digest", "n", "place")).alias("parts"))

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for data, parts in zip(_bodies(batch), batch.column("parts").to_pylist(), strict=True):
                for p in parts:
                    first, more = p["place"] >> 8, p["place"] & 255
                    out.append((p["anchor"], p["digest"], p["n"], data[first : first + more + size].tobytes()))
            if out:
                yield _record(["anchor", "digest", "n", "bytes"], map(list, zip(*out, strict=True)))

    joined = keyed.join(per_text, ["id", "hash"]).dropDuplicates(["id", "hash"]).select("body", "parts")
    return joined.mapInArrow(run, "anchor long, digest long, n long, bytes binary")


def _by_arrays(pieces: DataFrame, size: int) -> DataFrame:
    """``anchor, digest, lo, hi``: runs of repeated windows; a suffix array over whole minimizers at a time."""
    placed = pieces.repartition("anchor").sortWithinPartitions("anchor", "digest")
    names = ["anchor", "digest", "lo", "hi"]

    def run(batches):
        held: list[tuple] = []
        total = 0

        def closed():
            found = repeated_windows([(s, n) for _, _, n, s in held], size)
            spans = [runs(flags) for flags in found]
            k = [len(s) for s in spans]
            edges = np.concatenate(spans)
            return _record(names, [np.repeat(np.array([h[j] for h in held]), k) for j in (0, 1)] + [edges[:, 0], edges[:, 1] - 1])

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "digest", "n", "bytes")], strict=True):
                if total > PIECE and row[0] != held[-1][0]:
                    yield closed()
                    held, total = [], 0
                held.append(row)
                total += len(row[3])
        if held:
            yield closed()

    return placed.mapInArrow(run, "anchor long, digest long, lo long, hi long")


def _by_counts(pieces: DataFrame, size: int) -> DataFrame:
    """The same runs for minimizers with very many surroundings: windows counted by a 128-bit hash."""

    def run(batches):
        for batch in batches:
            for anchor, digest, n, body in zip(*[batch.column(c).to_pylist() for c in ("anchor", "digest", "n", "bytes")], strict=True):
                data = np.frombuffer(body, np.uint8)
                k = len(data) - size + 1
                at = np.arange(k)
                high = span_hashes(_BYTES[data], at, at + size)
                low = span_hashes(mixed(_BYTES[data]), at, at + size)
                yield _record(["anchor", "digest", "n", "high", "low", "at"], [*(np.full(k, v) for v in (anchor, digest, n)), signed(high), signed(low), at])

    rows = pieces.mapInArrow(run, "anchor long, digest long, n long, high long, low long, at long")
    often = rows.groupBy("high", "low").agg(F.sum("n").alias("times")).where("times > 1")
    marked = rows.join(often, ["high", "low"])
    return marked.select("anchor", "digest", F.col("at").alias("lo"), F.col("at").alias("hi"))


def marks(keyed: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``id, hash, lo, hi``: per text the runs of its repeated windows, as two arrays."""
    found = staged(segments(keyed, size, gram), "segments")
    twice = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    # staged, so that the join below deals out both sides itself and may split a hot anchor
    twice = staged(twice, "repeated-anchors")
    repeated = staged(found.join(twice, "anchor"), "repeated-segments")
    distinct = staged(repeated.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "hash", "place")).alias("one")
    ), "distinct-segments")
    sizes = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"))
    shards = staged(distinct.select("anchor", "digest", "n", "one.*").join(sizes, "anchor"), "shards")
    spans = _by_arrays(_with_bytes(keyed, shards.where(F.col("k") <= SHARD), size), size)
    many = shards.where(F.col("k") > SHARD)
    if not many.isEmpty():
        spans = spans.unionByName(_by_counts(_with_bytes(keyed, many, size), size))
    hit = repeated.join(staged(spans, "repeated-windows"), ["anchor", "digest"])
    first = F.shiftright("place", 8)
    return hit.groupBy("id", "hash").agg(F.collect_list(first + F.col("lo")).alias("lo"), F.collect_list(first + F.col("hi")).alias("hi"))


def removed_bytes(n: int, lo: np.ndarray, hi: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Which of ``n`` bytes are inside a repeated window; ``lo`` to ``hi`` are runs of windows."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, lo, 1)
    np.add.at(steps, hi + size, -1)
    return np.cumsum(steps[:-1]) > 0


def with_kept(docs: DataFrame, size: int = SIZE, gram: int = GRAM, text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row and, if asked for, ``spans`` and ``kept``.

    ``spans`` are the maximal removed runs as (first byte, end); ``kept`` is the remaining bytes.
    """
    keyed = _keyed(docs)
    joined = keyed.join(marks(keyed, size, gram), ["id", "hash"], "left").select("id", "hash", "body", "lo", "hi")
    names = ["id", "hash", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["spans", "kept"] * text
    kinds = [*[pa.int64()] * 5, pa.string()] + [pa.list_(pa.list_(pa.int64())), pa.binary()] * text

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            rows = zip(batch.column("id").to_pylist(), batch.column("hash").to_pylist(), _bodies(batch), batch.column("lo"), batch.column("hi"), strict=True)
            for key, hashed, data, lo, hi in rows:
                kept, edges, gone = data, np.zeros((0, 2), np.int64), 0
                if lo.is_valid:
                    away = removed_bytes(len(data), lo.values.to_numpy(), hi.values.to_numpy(), size)
                    kept, edges, gone = data[~away], runs(away), int(away.sum())
                row = (key, hashed, len(data), gone, len(edges), hashlib.sha256(kept.tobytes()).hexdigest())
                out.append((*row, edges.tolist(), kept.tobytes()) if text else row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    kind = "id long, hash long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    rows = joined.mapInArrow(run, kind + ", spans array<array<long>>, kept binary" * text)
    return rows.withColumn("doc_id", F.nullif("id", F.lit(NO_ID)))


def deduplicated(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``docs`` with repeated strings taken out of the texts; a text that loses nothing stays as it is."""
    short = with_kept(docs, size, gram).where("n_removed > 0").dropDuplicates(["id", "hash"])
    short = short.select(F.col("id").alias("_id"), F.col("hash").alias("_hash"), F.make_valid_utf8(F.col("kept").cast("string")).alias("_kept"))
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_hash"),
    )
    columns = {c: F.col(f"_row.`{c}`") for c in docs.columns}
    columns["text"] = F.coalesce(F.replace("_kept", F.lit("�"), F.lit("")), columns["text"])
    return own.join(short, ["_id", "_hash"], "left").select(*[v.alias(c) for c, v in columns.items()])


def op12_suffix_array_dedup(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return with_kept(docs, text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
