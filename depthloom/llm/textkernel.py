"""Vectorised word segmentation and hashing over Arrow string batches.

Texts stay in one UTF-8 byte buffer; words are byte ranges of it. No Python
object is made per word, so a core handles tens of MB of text per second.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_000_000
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_RNG = np.random.default_rng(20240229)
_ODD = 0x9E3779B97F4A7C15
_LANES = 2
_BYTE_VALUE = _RNG.integers(1, 2**63, size=(_LANES, 256), dtype=np.uint64)
_BASE = [0xD1342543DE82EF95, 0x2545F4914F6CDD1D]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def lower_ascii() -> np.ndarray:
    """Byte table that lower-cases A-Z and leaves every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def ascii_space() -> np.ndarray:
    """Separators 0x20 and 0x09-0x0D."""
    sep = np.zeros(256, bool)
    sep[[0x20, *range(0x09, 0x0E)]] = True
    return sep


def not_alnum() -> np.ndarray:
    """Separators: every ASCII byte but 0-9, A-Z and a-z."""
    sep = np.zeros(256, bool)
    sep[:128] = True
    for lo, hi in ((48, 58), (65, 91), (97, 123)):
        sep[lo:hi] = False
    return sep


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, bytes, offsets) with about ``limit`` bytes each; null counts as empty.

    A text is never split: one longer than ``limit`` makes a slice of its own.
    """
    for arr in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        yield from _array_slices(arr, limit)
    release()


def release() -> None:
    """Gives freed memory back to the system: worker processes live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _array_slices(arr: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    if len(arr) == 0:
        return
    arr = arr.fill_null("").cast(pa.large_binary())
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(arr):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(arr))
        yield row, end, whole[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row pointer): words of row r are starts[ptr[r]:ptr[r+1]]."""
    if len(buf) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~separators[buf]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(buf))]
    begins[edge] = word[edge]
    ends[edge - 1] = word[edge - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below at least n."""
    have = _POWERS.get(lane)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        base = _BASE[lane]
        out = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 4 * SLICE_BYTES:
            _POWERS[lane] = have
    return have


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(lane, len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[lane][buf] * power[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def value_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each stretch of 64-bit values. With several columns of ends, stretches of a row start together."""
    if len(starts) == 0:
        return np.zeros(np.shape(ends), np.uint64)
    power, inverse = _powers(lane, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    if ends.ndim > 1:
        starts = starts[:, None]
    return mix((total[ends] - total[starts]) * inverse[starts])


def gram_hashes(words: np.ndarray, n: int, lane: int = 0) -> np.ndarray:
    """Hash of each run of n words; shorter by n - 1 than its input (rows are not told apart)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(lane, len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return mix((total[n:] - total[:-n]) * inverse[: len(words) - n + 1] + np.uint64(n * _ODD % 2**64))


def inside(ptr: np.ndarray, n: int, count: int) -> np.ndarray:
    """Mask over word positions that start a run of n words within their row."""
    ok = np.zeros(max(count - n + 1, 0), bool)
    lengths = np.diff(ptr)
    run = np.maximum(lengths - n + 1, 0)
    if run.sum():
        first = np.repeat(ptr[:-1] - np.concatenate([[0], np.cumsum(run)[:-1]]), run)
        ok[first + np.arange(run.sum())] = True
    return ok
