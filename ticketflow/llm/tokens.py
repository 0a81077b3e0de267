"""Words of UTF-8 texts and their 64-bit hashes, by array operations.

A word is a maximal run of bytes other than space and \\x09-\\x0D; no word
crosses the end of a text.  The hash of a word is a polynomial over random
64-bit values of its (lower-cased) bytes, modulo 2^64, mixed at the end.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOW = _BYTE[LOWER]
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_pow = np.zeros(0, np.uint64)
_inv = np.zeros(0, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        m = max(n, 1 << 16)
        full = np.full(m, _P, np.uint64)
        full[0] = 1
        _pow = np.cumprod(full, dtype=np.uint64)
        full[1:] = _P_INV
        _inv = np.cumprod(full, dtype=np.uint64)
    return _pow, _inv


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two word hashes in order."""
    return mix(left * np.uint64(0xA0761D6478BD642F) + (right ^ np.uint64(0xE7037ED1A0B428DB)))


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and one past the last): byte places of all words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of data[start:end] for each span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    run = np.empty(len(data) + 1, np.uint64)
    run[0] = 0
    np.cumsum((_BYTE_LOW if lower else _BYTE)[data] * up[: len(data)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts])
