"""Words of whole texts as hash arrays, for the operators that run numpy inside tasks.

Everything works on the UTF-8 bytes of an Arrow string column, a bounded piece
at a time, so memory follows the piece and the longest text, not the table.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18          # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Separators of words: space and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(task):
    """A task function that gives freed memory back to the system at its end, as Spark keeps the worker for other tasks."""
    @functools.wraps(task)
    def run(*args):
        try:
            yield from task(*args)
        finally:
            give_back()
    return run


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit hashes."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Tables:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.size = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 2 * PIECE)
            self.up = _powers(_BASE, self.size)
            self.down = _powers(pow(_BASE, -1, 1 << 64), self.size)
        return self.up, self.down


_TABLES = _Tables()


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    column = column.fill_null("") if column.null_count else column
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, width)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def words(data: np.ndarray, edges: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word of a run of texts; ``edges`` has the first byte of each text and the end."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~separators[data]
    edge = np.diff(inside)
    starts, stops = edge == 1, edge == -1
    borders = edges[(edges > 0) & (edges < len(data))]
    cut = borders[(inside[borders] == 1) & (inside[borders + 1] == 1)]  # a word ends where a text ends
    starts[cut] = True
    stops[cut] = True
    return np.flatnonzero(starts), np.flatnonzero(stops)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray = LOWER) -> np.ndarray:
    """64-bit hash of each word [start, end), its bytes taken through ``letters`` (A-Z lower-cased)."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(ends, starts[first] + PIECE, "right"))
        last = max(last, first + 1)
        low, high = int(starts[first]), int(ends[last - 1])
        up, down = _TABLES.upto(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((letters[data[low:high]].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def documents(column: pa.Array, separators: np.ndarray = SPACE, limit: int = 4 * PIECE, letters: np.ndarray = LOWER
              ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes, word offsets of the rows) of runs of whole texts of about ``limit`` bytes."""
    data, at = bytes_of(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        end = min(end, rows)
        low, high = int(at[row]), int(at[end])
        piece = data[low:high]
        edges = at[row:end + 1] - low
        s, e = words(piece, edges, separators)
        yield row, end, word_hashes(piece, s, e, letters), np.searchsorted(s, edges)
        row = end


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words; of fewer words, the whole sequence as one."""
    if len(hashes) == 0:
        return hashes
    width = min(n, len(hashes))
    total = np.zeros(len(hashes) - width + 1, np.uint64)
    for j in range(width):
        total += hashes[j: len(hashes) - width + 1 + j] * np.uint64((_BASE * (2 * j + 3)) & 0xFFFFFFFFFFFFFFFF | 1)
    return np.unique(mix(total + np.uint64(width)))
