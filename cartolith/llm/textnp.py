"""Vectorised work on the UTF-8 bytes of Arrow string columns, a bounded piece of a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is a piece of its own.
PIECE = 1 << 17

_CACHE: dict = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constant(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit integers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 7919 + 1))


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    kind = np.int64 if wide else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offs, kind, len(col) + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at


def pieces(col, limit: int = PIECE):
    """(first row, bytes, offsets) of consecutive rows of at most ``limit`` bytes, one row at least."""
    raw, at = utf8(col)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + 4096)
        yield lo, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


P61 = np.uint64((1 << 61) - 1)
BASE_A, BASE_B, QUICK = 0x1E3779B97F4A7C15, 0x1132A2543DE82EF9, 0x9E3779B97F4A7C15


def mod61(x: np.ndarray) -> np.ndarray:
    """64-bit values modulo the prime 2 ** 61 - 1."""
    x = (x & P61) + (x >> np.uint64(61))
    x -= P61 * (x >= P61)
    return x


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2 ** 61 - 1 of values below it, from halves of 32 bits."""
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    ah, al, bh, bl = a >> half, a & low, b >> half, b & low
    mid = ah * bl + al * bh
    out = al * bl
    out = (out & P61) + (out >> np.uint64(61))
    out += (ah * bh) << np.uint64(3)
    out += (mid >> np.uint64(29)) + ((mid & np.uint64((1 << 29) - 1)) << half)
    return mod61(out)


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 61 - 1 for i < n."""
    have = _CACHE.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE + 8)
        have = np.ones(size, np.uint64)
        k = 1
        while k < size:
            m = min(k, size - k)
            have[k : k + m] = times(have[:m], np.uint64(pow(base, k, int(P61))))
            k += m
        _CACHE.clear() if len(_CACHE) > 8 else None
        if size <= 4 * PIECE:
            _CACHE[base] = have
    return have[:n]


class Rolling:
    """Polynomial hashes modulo the prime 2 ** 61 - 1 of any byte ranges of a piece: two different strings of n bytes collide
    for n bases of 2 ** 61 at most.  Codes count with 32 bits; values are mixed to 64 bits with the length."""

    def __init__(self, codes: np.ndarray, base: int):
        n, low, half = len(codes), np.uint64(0xFFFFFFFF), np.uint64(32)
        weight, code = powers(base, n), codes & low
        term = code * (weight & low)
        term = (term & P61) + (term >> np.uint64(61))
        mid = code * (weight >> half)
        term += mid >> np.uint64(29)
        term += (mid & np.uint64((1 << 29) - 1)) << half  # below 2 ** 63
        self.sums = np.zeros(n + 1, np.uint64)
        high = np.cumsum(term >> half)  # sums of halves do not overflow for pieces of up to 2 ** 31 bytes
        term &= low
        # high * 2 ** 32: its bits from 29 up wrap round to bit 0
        self.sums[1:] = mod61((high >> np.uint64(29)) + ((high & np.uint64((1 << 29) - 1)) << half) + mod61(np.cumsum(term)))
        self.back = powers(pow(base, -1, int(P61)), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = mod61(self.sums[end] + (P61 - self.sums[start]))
        return mix64(times(x, self.back[start]) + mix64((end - start).astype(np.uint64)))


class Quick:
    """Polynomial hashes modulo 2 ** 64, for choices that need not be free of collisions: names come from Rolling."""

    def __init__(self, codes: np.ndarray, base: int = QUICK):
        n = len(codes)
        weight = np.full(n + 1, base, np.uint64)
        weight[0] = 1
        np.multiply.accumulate(weight, out=weight)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * weight[:n], out=self.sums[1:])
        self.back = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
        self.back[0] = 1
        np.multiply.accumulate(self.back, out=self.back)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.back[start])




def codes(seed: int, lower: bool = False) -> np.ndarray:
    """A 64-bit code for each byte; with ``lower``, A-Z have those of a-z."""
    c = constant(seed, 256)
    if lower:
        c[65:91] = c[97:123]
    return c


def spaces() -> np.ndarray:
    s = np.zeros(256, bool)
    s[[0x20, *range(0x09, 0x0E)]] = True
    return s


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the maximal runs of marked bytes, none of which crosses rows."""
    if not len(inside):
        z = np.zeros(0, np.int64)
        return z, z, z
    first, last = np.empty_like(inside), np.empty_like(inside)
    first[0] = last[-1] = True
    first[1:], last[:-1] = ~inside[:-1], ~inside[1:]
    filled = offs[:-1] < offs[1:]
    first[offs[:-1][filled]] = True
    last[offs[1:][filled] - 1] = True
    start, end = np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def gear(buf: np.ndarray) -> np.ndarray:
    """Gear hash at each byte, of the last 32 bytes: h = (h << 1) + G[byte] in 32 bits, by doubling."""
    h = (constant(5, 256) >> np.uint64(32)).astype(np.uint32)[buf]
    for k in (1, 2, 4, 8, 16):
        later = h.copy()
        later[k:] += h[:-k] << np.uint32(k)
        h = later
    return h


def as_long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))
