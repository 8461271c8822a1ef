"""Canonical length-limited Huffman codes over token ids: code, encode, decode (numpy, no Spark).

Code lengths come from package-merge under ``MAX_BITS``; codes are canonical, so lengths alone define
them.  A block is decoded from any of its checkpoints (a bit offset every ``EVERY`` ids): all stretches
between checkpoints advance together, one table look-up of ``MAX_BITS`` bits per id.
"""

from __future__ import annotations

import numpy as np

MAX_BITS = 20
EVERY = 256


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits per symbol (0: symbol does not occur), optimal among codes of at most ``limit`` bits."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    items = counts[order].astype(np.float64)
    levels, packages = [], items[:0]
    for _ in range(limit):
        both = np.concatenate([items, packages])
        place = np.argsort(both, kind="stable")
        levels.append(np.cumsum(place < len(items)))
        both = both[place]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    taken, bits = 2 * len(items) - 2, np.zeros(len(items), np.uint8)
    for single in reversed(levels):
        if taken == 0:
            break
        n = int(single[taken - 1])
        bits[:n] += 1
        taken = 2 * (taken - n)
    lengths[order] = bits
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: ascending by (length, symbol)."""
    out = np.zeros(len(lengths), np.uint64)
    code = last = 0
    for symbol in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[symbol])
        if n:
            code = (code << (n - last)) if last else 0
            out[symbol], last = code, n
            code += 1
    return out


def encode(ids: np.ndarray, lengths: np.ndarray, code: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of a block and its checkpoints."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    at = ends - n
    shift = (64 - (at & 31) - n).astype(np.uint64)
    value = code[ids] << shift
    word, size = at >> 5, (int(ends[-1]) >> 5) + 2 if len(ids) else 1
    # codes don't overlap: sums of the pieces of a 32-bit word are exact
    high = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), size)
    low = np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size)
    return (high[:size] + low[:size]).astype(">u4").tobytes(), at[::EVERY]


def decoding_table(lengths: np.ndarray, limit: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length for every value of the next ``limit`` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (limit - lengths[order].astype(np.int64))
    symbols, bits = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.uint8)
    symbols[: spans.sum()] = np.repeat(order, spans)
    bits[: spans.sum()] = np.repeat(lengths[order], spans)
    return symbols, bits


def decode(data: bytes, n: int, checkpoints: np.ndarray, table, limit: int = MAX_BITS) -> np.ndarray:
    """The ``n`` ids of a block."""
    symbols, bits = table
    words = np.concatenate([np.frombuffer(data, ">u4").astype(np.uint64), np.zeros(EVERY * limit // 32 + 2, np.uint64)])
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    at = np.asarray(checkpoints, np.int64).copy()
    out = np.empty((EVERY, len(at)), np.uint32)
    mask = np.uint64((1 << limit) - 1)
    for step in range(min(EVERY, n)):
        value = (pairs[at >> 5] >> (64 - limit - (at & 31)).astype(np.uint64)) & mask
        out[step] = symbols[value]
        at += bits[value]
        np.minimum(at, len(pairs) * 32 - 32, out=at)
    return out.T.reshape(-1)[:n]
