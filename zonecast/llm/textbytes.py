"""Vectorised numpy helpers over the UTF-8 buffer of an Arrow string column.

All functions work on one *slice* of a batch: the bytes of a few hundred
texts laid end to end, with the offsets at which each text starts.  Words,
word hashes and n-gram hashes come from a handful of array passes, so Python
work is per slice, never per row or word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: full avalanche, bijective."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def stream(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th of a family of independent-looking hashes of ``x``."""
    return mix(x + np.uint64(((k + 1) * 0x9E3779B97F4A7C15) & _MASK))


# One random value per byte; A-Z share the values of a-z where case is folded.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[0x41:0x5B] = BYTE_VALUES[0x61:0x7B]

_BASE = 0xB5297A4D3F84D5B5 | 1          # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, grown by doubling and kept."""
    have = _POWERS.get(base)
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _POWERS[base] = have
    return have[:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums ``H`` with ``(H[j] - H[i]) * inverse_power(i)`` the hash of ``values[i:j]``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * powers(_BASE_INVERSE, len(prefix))[start])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` pieces of about ``limit`` bytes.

    A null text has no bytes.  A text longer than the limit is a piece of its
    own and stays whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], (offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A lookup table that is true for the bytes of the (inclusive) ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


# Letters and digits of ASCII, and every byte of a longer UTF-8 sequence.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
# Everything but ASCII white space.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, row)`` of every word: a maximal run of the table's bytes inside one text."""
    inside = table[data]
    n = len(data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, with A-Z folded to a-z."""
    return span_hash(prefix_hash(FOLDED_VALUES[data]), start, end)


def gram_hashes(word: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``len(word) - k + 1`` runs of ``k`` words (across rows: mask afterwards)."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out + word[j:j + n]) * MULTIPLIER
        out ^= out >> np.uint64(29)
    return mix(out + np.uint64(k))


def int64_lists(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    """An Arrow list<int64> column from list lengths and the flat values."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64)))
