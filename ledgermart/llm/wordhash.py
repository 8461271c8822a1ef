"""Words of a text as 64-bit hashes, and rolling hashes over them (numpy, no Spark)."""

from __future__ import annotations

import hashlib

import numpy as np

_U = np.uint64
_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2^64, and of its inverse."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << max(n, 1 << 12).bit_length()
        up = np.full(size, base, _U)
        down = np.full(size, pow(base, -1, 1 << 64), _U)
        up[0] = down[0] = 1
        known = _powers[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return known


def bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _BLANK[data], [True]])))
    return edge[::2], edge[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash per word of UTF-8 text."""
    data = np.frombuffer(text, np.uint8)
    start, end = bounds(data)
    if not len(start):
        return np.zeros(0, _U)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=total[1:])
    value = (total[end] - total[start]) * down[start]
    return mixed(value + (end - start).astype(_U) * _U(_STEP))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    for k in range(size):
        total = total * _U(_STEP) + words[k : k + n]
    return mixed(total)


def span_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One hash per span ``[start, end)`` of words."""
    up, down = powers(len(words) + 1, _STEP)
    total = np.zeros(len(words) + 1, _U)
    np.cumsum(words * up[: len(words)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(_U))


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values of a fresh array, sorted; on short arrays a fifth of the time of ``np.unique``."""
    x.sort()
    repeats = x[1:] == x[:-1]
    return x[np.concatenate([[True], ~repeats])] if repeats.any() else x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def set_digest(values: np.ndarray) -> bytes:
    """128 bits that name a sorted array of hashes."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
