"""Vectorised text primitives on Arrow batches: slices, word bounds, word and n-gram hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_MASK = (1 << 64) - 1
#: Odd multipliers of the polynomial hashes (any odd values serve).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
CHECK_BASE = 0xAF251AF3B0F025B5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(BYTE_BASE))
_LOWER_BYTE = _BYTE[np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        have = _POWERS[base] = (np.cumprod(up), np.cumprod(down))
    return have[0][:n], have[1][:n]


def run_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair of bounds."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


def slices(
    column: pa.Array, limit: int = 1 << 21
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, bounds)`` of runs of about ``limit`` bytes; nulls are empty.

    Whole texts always stay together; ``bounds`` has one more entry than rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = pc.fill_null(column, "").cast(pa.large_string())
    if not len(a):
        return
    bounds = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(a):
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
        hi = min(hi, len(a))
        yield lo, hi, data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; words never cross rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    end[:-1] &= ~solid[1:] | edge[1:-1]
    s = np.flatnonzero(start)
    row = np.searchsorted(bounds, s, "right") - 1
    return s, np.flatnonzero(end) + 1, row


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word (``lower``: of its A-Z folded form)."""
    return run_hash((_LOWER_BYTE if lower else _BYTE)[data], s, e, BYTE_BASE)


def gram_hashes(h: np.ndarray, n: int, base: int = WORD_BASE) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values; ``len(h) - n + 1`` of them."""
    if len(h) < n:
        return np.zeros(0, U64)
    i = np.arange(len(h) - n + 1)
    return run_hash(h, i, i + n, base)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each run of ``n`` consecutive values."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = np.minimum(x[:-step], x[step:]) if len(x) > step else x[:0]
        have += step
    return x


def runs_of(keep: np.ndarray, length: int, size: int) -> np.ndarray:
    """Mask of ``size`` positions covered by ``[k, k + length)`` for each k in ``keep``."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, keep, 1)
    np.add.at(change, np.minimum(keep + length, size), -1)
    return np.cumsum(change[:-1]) > 0


def row_bounds(row: np.ndarray, rows: int) -> np.ndarray:
    """Bounds of each row's items in the sorted array ``row``."""
    return np.searchsorted(row, np.arange(rows + 1))


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
