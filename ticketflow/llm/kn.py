"""Numbers of interpolated modified Kneser-Ney smoothing and packed arrays of counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .tokens import hashes, spans

#: Hashes of the marks that begin and end a text; no word has them by chance (2^-64 each).
BEGIN = np.uint64(0x5A17C0DE00000001)
END = np.uint64(0x5A17C0DE00000002)


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """D1, D2, D3+ from how many entries have counts 1 to 4.  Where a count of
    counts is 0 (tiny corpora) the estimate is undefined and half the count's step stands in."""
    if not n1:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2 if n2 else 0.75
    d3 = 3 - 4 * y * n4 / n3 if n3 else 0.9
    return min(max(d1, 0.05), 1.0), min(max(d2, 0.05), 2.0), min(max(d3, 0.05), 3.0)


def discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """max(c - D(c), 0) for each count."""
    table = np.array([0.0, *d])
    return np.maximum(counts - table[np.minimum(counts, 3).astype(np.int64)], 0.0)


def steps(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, first): the pairs a model predicts, word after word and the end
    after the last, text by text; text i owns rows first[i] to first[i + 1]."""
    s, e, word_first = spans(data, offsets)
    h = hashes(data, s, e)
    n = len(offsets) - 1
    first = word_first + np.arange(n + 1)
    right = np.full(int(first[-1]), END, np.uint64)
    right[np.arange(len(h)) + np.repeat(np.arange(n), np.diff(word_first))] = h
    left = np.empty_like(right)
    left[1:] = right[:-1]
    left[first[:-1]] = BEGIN
    return left, right, first


def sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of each value over equal keys."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return (k[cut], *[np.add.reduceat(v[order], cut) for v in values])


def pack(a: np.ndarray) -> bytes:
    """An unsigned array, byte planes together, compressed."""
    wide = np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(wide).tobytes(), codec="zstd", asbytes=True) if len(a) else b""


def unpack(b: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(pa.decompress(b, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view("<u8").ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(b: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(b, n), dtype=np.uint64)
