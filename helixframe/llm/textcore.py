"""Vectorised text primitives in numpy: words, rolling hashes, shingles. Whole texts, no per-word Python."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
INVERSE = U(pow(int(BASE), -1, 1 << 64))
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A random 64-bit value for each byte, so that the rolling hash isn't linear in the byte's value.
BYTE_VALUE = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=U) | U(1)
LOWER_VALUE = BYTE_VALUE[LOWER]
POSITION = np.random.default_rng(7).integers(0, 1 << 64, 8, dtype=U) | U(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers["up"]) < n:
        m = 1 << max(16, int(n - 1).bit_length())
        with np.errstate(over="ignore"):
            for k, b in (("up", BASE), ("down", INVERSE)):
                x = np.full(m, b, U)
                x[0] = U(1)
                _powers[k] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def prefix_hash(raw: np.ndarray, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """P with P[e] - P[s] = hash of raw[s:e] times BASE**s."""
    up, _ = powers(len(raw) + 1)
    out = np.empty(len(raw) + 1, U)
    out[0] = 0
    np.cumsum(values[raw] * up[: len(raw)], out=out[1:])
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each raw[start:end], the same for equal bytes anywhere."""
    _, down = powers(len(p))
    return (p[end] - p[start]) * down[start]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run without white space inside a row, and the number of words before each row."""
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    word = ~WHITE[raw]
    before = np.empty(n, bool)
    before[0], before[1:] = True, ~word[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = True
    start = np.flatnonzero(word & before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~word[1:]
    after[inner - 1] = True
    end = np.flatnonzero(word & after) + 1
    return start, end, np.searchsorted(start, offsets)


def shingle_hashes(raw: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """For each row the sorted distinct 64-bit hashes of its word shingles, words lower-cased in A-Z.

    A row of fewer words than `width` has its whole word sequence as one shingle; without words, none.
    """
    start, end, first = word_spans(raw, offsets)
    words = mix(span_hash(prefix_hash(raw, LOWER_VALUE), start, end) + (end - start).astype(U))
    out, counts = [], np.diff(first)
    if len(words) >= width:
        every = words[: len(words) - width + 1] * POSITION[0]
        for k in range(1, width):
            every = every + words[k : len(words) - width + 1 + k] * POSITION[k]
        every = mix(every)
    for a, n in zip(first[:-1].tolist(), counts.tolist(), strict=True):
        if n >= width:
            x = np.sort(every[a : a + n - width + 1])
            keep = np.empty(len(x), bool)
            keep[0] = True
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            out.append(x[keep])
        elif n:
            x = np.array([n], U) * POSITION[7] + (words[a : a + n] * POSITION[:n]).sum(dtype=U, keepdims=True)
            out.append(mix(x))
        else:
            out.append(np.zeros(0, U))
    return out
