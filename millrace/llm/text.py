"""Words and word shingles of Arrow text columns, hashed in bulk with NumPy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D of the text in
UTF-8, with A-Z lower-cased. Hashes have 64 bits; two different shingles share
one with a probability of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
THRESHOLD_PERCENT = 75
#: Bytes of text handled at once; a longer text is cut at white space.
BLOCK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_STEP = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def _byte_codes() -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    codes[65:91] = codes[97:123]
    return codes


_CODE = _byte_codes()
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for n positions at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        inverse = pow(int(_BASE), -1, 1 << 64)
        _powers[:] = [np.multiply.accumulate(np.concatenate(([_U(1)], np.full(size - 1, b, dtype=np.uint64)))) for b in (_BASE, _U(inverse))]
    return _powers[0], _powers[1]


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library than glibc
    _trim = None


def release() -> None:
    """Give the system back what earlier groups or tasks of this Python worker have freed.

    Workers live on between tasks, and neither Arrow's pool nor malloc returns memory by itself.
    """
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The data and the n + 1 offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word of texts that lie one after another in ``data``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    full = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] = word[heads]
    last[tails] = word[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _power_tables(n)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_CODE[data] * power[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(offsets, starts, side="right") - 1


def _long_words(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, block by block."""
    found, at = [], 0
    while at < len(data):
        to, size = len(data), BLOCK
        while at + size < len(data):
            gaps = np.flatnonzero(_SPACE[data[at : at + size]])
            if len(gaps):
                to = at + int(gaps[-1]) + 1
                break
            size *= 2
        found.append(_words(data[at:to], np.array([0, to - at]))[0])
        at = to
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows and the n + 1 offsets of each row's words."""
    hashes, counts = [], np.zeros(len(offsets), dtype=np.int64)
    for lo, hi in slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        if len(part) > BLOCK:
            found = _long_words(part)
            counts[lo + 1] = len(found)
        else:
            found, rows = _words(part, offsets[lo : hi + 1] - offsets[lo])
            counts[lo + 1 : hi + 1] = np.bincount(rows, minlength=hi - lo)
        hashes.append(found)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.cumsum(counts)


def _weight(j: int) -> np.uint64:
    return _U(pow(_STEP, j, 1 << 64))


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows, in order and with repeats, and each row's offsets.

    A row with fewer than n words, but at least one, has its whole sequence as one shingle.
    """
    hashes, at = words(data, offsets)
    counts = np.diff(at)
    if not len(hashes):
        return hashes, np.zeros(len(offsets), np.int64)
    sums = np.zeros(max(0, len(hashes) - n + 1), dtype=np.uint64)
    for j in range(n):
        sums += hashes[j : j + len(sums)] * _weight(j)
    rows = np.repeat(np.arange(len(counts)), np.maximum(counts - n + 1, 0))
    size = np.maximum(counts - n + 1, 0)
    shift = np.cumsum(size) - size
    picked = sums[at[:-1][rows] + (np.arange(len(rows)) - shift[rows])] if len(rows) else np.zeros(0, np.uint64)
    full = mix(picked + _U(n))
    short = np.flatnonzero((counts > 0) & (counts < n))
    if not len(short):
        return full, np.concatenate(([0], np.cumsum(size)))
    whole = np.zeros(len(short), dtype=np.uint64)
    for j in range(n - 1):
        has = counts[short] > j
        whole[has] += hashes[at[short[has]] + j] * _weight(j)
    whole = mix(whole + counts[short].astype(np.uint64))
    size[short] = 1
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]), dtype=np.uint64)
    mask = np.ones(len(out), dtype=bool)
    mask[ends[short] - 1] = False
    out[mask], out[~mask] = full, whole
    return out, np.concatenate(([0], ends))


def prefix_size(n: int | np.ndarray, percent: int = THRESHOLD_PERCENT):
    """Elements of a set of n of which one at least lies in any part of ``percent`` of it."""
    return n - (n * percent + 99) // 100 + 1
