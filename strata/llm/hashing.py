"""64-bit hashes of words and word sequences from prefix sums of a polynomial, in numpy."""

from __future__ import annotations

import numpy as np

SLICE = 1 << 20  # bytes, or words, summed at a time
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^0 .. BASE^n and the same of its inverse."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, SLICE + 1)
        _POWERS[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))]) for b in (BASE, INVERSE)]
    return _POWERS[0], _POWERS[1]


def polynomials(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sum of values[i] * BASE^-(i - first) over each [first, last), from prefix sums."""
    up, down = powers(len(values))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * down[:len(values)])])
    return (prefix[last] - prefix[first]) * up[first]


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of True starts and ends."""
    padded = np.concatenate([[False], inside, [False]])
    edge = np.flatnonzero(padded[1:] != padded[:-1])
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word, whole words of about SLICE bytes at a time."""
    out, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        base = start[at]
        to = max(at + 1, int(np.searchsorted(end, base + SLICE, "right")))
        part = BYTES[data[base:end[to - 1]]]
        out[at:to] = mixed(polynomials(part, start[at:to] - base, end[at:to] - base))
        at = to
    return out


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` words from each word on."""
    out = []
    for at in range(0, max(len(words) - n + 1, 0), SLICE):
        part = words[at:at + SLICE + n - 1]
        first = np.arange(len(part) - n + 1)
        out.append(polynomials(part, first, first + n))
    return np.concatenate(out) if out else np.empty(0, np.uint64)
