"""Byte-level helpers shared by the operators that work on Arrow batches.

A batch is cut into runs of rows holding at most ``CHUNK_BYTES`` of text (a
longer document forms a run of its own), so memory follows that figure or the
longest document, never the batch.  All functions are vectorised with numpy and
look at whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time inside a task.
CHUNK_BYTES = 1 << 21

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INV = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTE_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32

#: Bytes of a word: 0-9, a-z after lower-casing A-Z, and all of a multi-byte character.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True

_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse (modulo 2**64)."""
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("p", BASE), ("i", BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["p"][:n], _POWERS["i"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1 + column.offset)[column.offset:]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def row_runs(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def text_chunks(column, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of each run of rows."""
    data, offsets = text_buffers(column)
    for lo, hi in row_runs(offsets, limit):
        own = offsets[lo:hi + 1]
        yield lo, hi, data[own[0]:own[-1]], own - own[0]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h with h[j] - h[i] the (unnormalised) polynomial hash of bytes i..j-1."""
    power, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * power[:len(data)], dtype=np.uint64, out=out[1:])
    return out


def slice_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, the same wherever it lies."""
    _, inverse = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start])


def word_bounds(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of set bytes; runs end with their row."""
    n = len(mask)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    edge = offsets[:-1][offsets[:-1] < n]
    before[edge] = False
    edge = offsets[1:][offsets[1:] > 0]
    after[edge - 1] = False
    start = np.flatnonzero(mask & ~before)
    end = np.flatnonzero(mask & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def words(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased words of each row: their start, end, row and 64-bit hash."""
    low = LOWER_ASCII[data]
    start, end, row = word_bounds(WORD_BYTES[low], offsets)
    return low, start, end, row, slice_hash(prefix_hash(low), start, end)


def row_starts(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Where each row's entries begin in an array sorted by row (n_rows + 1 values)."""
    return np.searchsorted(row, np.arange(n_rows + 1))
