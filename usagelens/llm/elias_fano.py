"""Elias-Fano code of a non-decreasing sequence, with select.

A value below ``universe`` is cut into ``low`` bits kept as they are and an
upper part kept in unary: a one for every value, a zero for every step of
the upper part.  About 2 + log2(universe / n) bits a value.  ``select`` of
the i-th one gives the upper part; 32-bit counts of the ones before every
512-bit block lead to the block, so no table of 64-bit offsets is kept.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512


def low_bits(n: int, universe: int) -> int:
    return max(0, (universe // n).bit_length() - 1) if n else 0


def encode(values: np.ndarray, universe: int) -> tuple[int, bytes, bytes, bytes]:
    """(number of low bits, low part, upper part, ones before each block)."""
    values = np.asarray(values, np.int64)
    n = len(values)
    bits = low_bits(n, universe)
    low = (values[:, None] >> np.arange(bits)) & 1
    size = n + (universe >> bits) + 1
    upper = np.zeros(-(-size // BLOCK) * BLOCK, np.uint8)
    upper[(values >> bits) + np.arange(n)] = 1
    ones = upper.reshape(-1, BLOCK).sum(1, dtype=np.int64)
    return (bits, np.packbits(low.astype(np.uint8).reshape(-1), bitorder="little").tobytes(),
            np.packbits(upper, bitorder="little").tobytes(), (np.cumsum(ones) - ones).astype("<u4").tobytes())


def select(i: np.ndarray, bits: int, low: bytes, upper: bytes, ones: bytes) -> np.ndarray:
    """The values at the places ``i``."""
    i = np.asarray(i, np.int64)
    if not len(i):
        return np.zeros(0, np.int64)
    before = np.frombuffer(ones, "<u4").astype(np.int64)
    block = np.searchsorted(before, i, "right") - 1
    used, row = np.unique(block, return_inverse=True)
    words = np.frombuffer(upper, np.uint8).reshape(-1, BLOCK // 8)
    out = np.empty(len(i), np.int64)
    for at in range(0, len(used), 4096):  # so many blocks are unpacked at once
        mine = (row >= at) & (row < at + 4096)
        part = np.unpackbits(words[used[at:at + 4096]], axis=1, bitorder="little")
        r, c = np.nonzero(part)
        first = np.searchsorted(r, np.arange(len(part)))
        out[mine] = c[first[row[mine] - at] + i[mine] - before[block[mine]]] + block[mine] * BLOCK
    high = (out - i) << bits
    if not bits:
        return high
    place = i[:, None] * bits + np.arange(bits)
    data = np.frombuffer(low, np.uint8)
    got = (data[place >> 3] >> (place & 7).astype(np.uint8)) & 1
    return high | (got.astype(np.int64) << np.arange(bits)).sum(1)
