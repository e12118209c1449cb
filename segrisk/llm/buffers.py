"""Texts of an Arrow column as byte arrays, and hashes of their words and windows.

Helpers that run inside tasks. Everything is vectorised over a slice of a
batch; a slice ends after the row that brings it to ``SLICE`` bytes, so memory
is bounded by the longest text, at a few hundred bytes for each byte of a slice. Words are hashed eight bytes at a time,
each step mixed with the one before; ranges of a running text have polynomials modulo 2**64 over prefix
sums, which regular texts of many hundred bytes can make equal.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE = 1 << 19
# What a batch no longer needs goes back to the system, as workers live on between tasks.
pa.set_memory_pool(pa.system_memory_pool())
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}

#: Bytes between words: blank and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Longer words are hashed one by one.
LONG = 64
# Of eight bytes, the first 0 to 8.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64; kept for the largest n so far."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, SLICE + 4096)
        row = np.full(size, base, np.uint64)
        row[0] = 1
        have = _powers[int(base)] = np.cumprod(row, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """What arrays no longer need goes back to the system too, where the C library can do so.

    Else a worker that waits for its next task keeps the most it ever had.
    """
    if _trim is not None:
        _trim(ctypes.c_size_t(0))


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offsets of its rows (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole, offsets


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of slices of a string column."""
    whole, offsets = as_bytes(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        end = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right"))))
        yield at, end, whole[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end
    give_back()


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H[i]: polynomial of the first i bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=out[1:], dtype=np.uint64)
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes start..end, the same wherever those bytes stand."""
    own = (prefix[end] - prefix[start]) * powers(_INVERSE, len(prefix))[start]
    return mix(own + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, and from the end; zeros follow the data."""
    return np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes start..end of every word, the same wherever those bytes stand."""
    n = end - start
    eights = lanes(data)
    out = mix(n.astype(np.uint64) + _BASE)
    short = n <= LONG
    for k in range(0, int(n[short].max(initial=0)), 8):
        on = np.flatnonzero(short & (n > k))
        own = eights[start[on] + k] & _FIRST[np.minimum(n[on] - k, 8)]
        out[on] = mix((out[on] ^ own) + _BASE)
    raw = memoryview(np.ascontiguousarray(data))
    for i in np.flatnonzero(~short).tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[start[i] : end[i]])
    return out


def same_words(
    a: np.ndarray, a_start: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_size: np.ndarray
) -> np.ndarray:
    """Which words of the bytes ``a`` are equal to those of the bytes ``b``."""
    out = a_size == b_size
    short = a_size <= LONG
    one, two = lanes(a), lanes(b)
    for k in range(0, int(a_size[short].max(initial=0)), 8):
        on = np.flatnonzero(out & short & (a_size > k))
        differ = one[a_start[on] + k] ^ two[b_start[on] + k]
        out[on] = differ & _FIRST[np.minimum(a_size[on] - k, 8)] == 0
    for i in np.flatnonzero(out & ~short).tolist():
        n = int(a_size[i])
        out[i] = np.array_equal(a[a_start[i] : a_start[i] + n], b[b_start[i] : b_start[i] + n])
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and how many words each row has."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    at = np.searchsorted(start, offsets)
    return start, end, np.diff(at)


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``width`` words, and how many windows each row has.

    A row with fewer words has one window of all its words; without words, none.
    """
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), n)
    at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    last = first[row] + counts[row]
    out = np.zeros(len(row), np.uint64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for k in range(width):
        out = mix(out + np.where(at + k < last, padded[at + k], np.uint64(k + 1)))
    return out, n


def word_shingles(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, width: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the rows of a slice, repeats included, and their number per row."""
    data = LOWER[data] if lower else data
    start, end, counts = words(data, offsets)
    return shingles(word_hashes(data, start, end), counts, width)
