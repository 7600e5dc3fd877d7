"""Stable sample ids: the published FarmHash Fingerprint64 of a JSON list, reduced to a positive long.

Plain Python over distinct sample names on the driver or in a pandas UDF; names are few beside variants. Lengths under
8 and over 64 bytes follow the published algorithm but no known vector covers them here.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

M = (1 << 64) - 1
#: Fixed constants of the published hash.
K0, K1, K2 = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F


def _rot(x: int, n: int) -> int:
    return ((x >> n) | (x << (64 - n))) & M


def _fold(u: int, v: int, mul: int) -> int:
    a = ((u ^ v) * mul) & M
    a ^= a >> 47
    b = ((v ^ a) * mul) & M
    b ^= b >> 47
    return (b * mul) & M


def fingerprint64(s: bytes) -> int:
    n = len(s)

    def f(i: int, w: int = 8) -> int:
        return int.from_bytes(s[i : i + w], "little")

    mul = (K2 + 2 * n) & M
    if n > 64:
        return _long(s)
    if n > 32:
        a, b, c, d = f(0) * K2 & M, f(8), f(n - 8) * mul & M, f(n - 16) * K2 & M
        y = (_rot((a + b) & M, 43) + _rot(c, 30) + d) & M
        z = _fold(y, (a + _rot((b + K2) & M, 18) + c) & M, mul)
        e, g = f(16) * mul & M, f(24)
        h, i = (y + f(n - 32)) * mul & M, (z + f(n - 24)) * mul & M
        return _fold((_rot((e + g) & M, 43) + _rot(h, 30) + i) & M, (e + _rot((g + a) & M, 18) + h) & M, mul)
    if n > 16:
        a, b, c, d = f(0) * K1 & M, f(8), f(n - 8) * mul & M, f(n - 16) * K2 & M
        return _fold((_rot((a + b) & M, 43) + _rot(c, 30) + d) & M, (a + _rot((b + K2) & M, 18) + c) & M, mul)
    if n >= 8:
        a, b = (f(0) + K2) & M, f(n - 8)
        return _fold((_rot(b, 37) * mul + a) & M, ((_rot(a, 25) + b) * mul) & M, mul)
    if n >= 4:
        return _fold((n + (f(0, 4) << 3)) & M, f(n - 4, 4), mul)
    if n:
        y, z = s[0] + (s[n >> 1] << 8), n + (s[-1] << 2)
        x = (y * K2 ^ z * K0) & M
        return ((x ^ (x >> 47)) * K2) & M
    return K2


def _long(s: bytes) -> int:
    n = len(s)

    def f(i: int) -> int:
        return int.from_bytes(s[i : i + 8], "little")

    def weak(i: int, a: int, b: int) -> tuple[int, int]:
        w, x, y, z = f(i), f(i + 8), f(i + 16), f(i + 24)
        a = (a + w) & M
        b = _rot((b + a + z) & M, 21)
        c = a
        a = (a + x + y) & M
        return (a + z) & M, (b + _rot(a, 44) + c) & M

    seed = 81
    x, y = (seed * K2 + f(0)) & M, (seed * K1 + 113) & M
    z = (y * K2 + 113) & M
    z = ((z ^ (z >> 47)) * K2) & M
    v, w = (0, 0), (0, 0)
    x = (seed * K2 + f(0)) & M
    end, last = (n - 1) // 64 * 64, n - 64
    i = 0
    while i != end:
        x = _rot((x + y + v[0] + f(i + 8)) & M, 37) * K1 & M
        y = _rot((y + v[1] + f(i + 48)) & M, 42) * K1 & M
        x ^= w[1]
        y = (y + v[0] + f(i + 40)) & M
        z = _rot((z + w[0]) & M, 33) * K1 & M
        v = weak(i, v[1] * K1 & M, (x + w[0]) & M)
        w = weak(i + 32, (z + w[1]) & M, (y + f(i + 16)) & M)
        z, x = x, z
        i += 64
    mul = (K1 + ((z & 0xFF) << 1)) & M
    i = last
    w = ((w[0] + ((n - 1) & 63)) & M, w[1])
    v = ((v[0] + w[0]) & M, v[1])
    w = ((w[0] + v[0]) & M, w[1])
    x = _rot((x + y + v[0] + f(i + 8)) & M, 37) * mul & M
    y = _rot((y + v[1] + f(i + 48)) & M, 42) * mul & M
    x ^= w[1] * 9 & M
    y = (y + v[0] * 9 + f(i + 40)) & M
    z = _rot((z + w[0]) & M, 33) * mul & M
    v = weak(i, v[1] * mul & M, (x + w[0]) & M)
    w = weak(i + 32, (z + w[1]) & M, (y + f(i + 16)) & M)
    z, x = x, z
    a = (_fold(v[0], w[0], mul) + ((y ^ (y >> 47)) * K0) + z) & M
    return _fold(a, (_fold(v[1], w[1], mul) + x) & M, mul)


def stable_id(parts: list[str], modulus: int = (1 << 63) - 1) -> int:
    return fingerprint64(json.dumps(parts).encode()) % modulus


def sample_id(name: str, file_path: str | None = None) -> int:
    """The id of a sample; with a file path, of the sample in that file."""
    if not name or file_path == "":
        raise ValueError("a sample needs a name, and a file path must not be empty")
    return stable_id([name if file_path is None else re.sub(r"\W", "_", file_path) + "_" + name], 1 << 63)


@F.pandas_udf(T.LongType())
def sample_ids(names: pd.Series) -> pd.Series:
    """For a column of distinct sample names."""
    return names.map(sample_id)
