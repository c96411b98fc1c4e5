"""Helpers shared by the Arrow-batched operators of this package.

Texts of an Arrow batch are handled as one byte buffer with offsets, so that
numpy works over all rows of the batch at once instead of row by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space of the word rule (space, tab to carriage return).
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def filled(column: pa.Array) -> pa.Array:
    """The column as strings, null as the empty text."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the n + 1 row offsets."""
    column = filled(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(off) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def row_slices(offsets: np.ndarray, max_bytes: int, max_rows: int | None = None) -> list[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` (a longer row is alone) and at most ``max_rows`` each."""
    out, at, n = [], 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        out.append((at, min(end, n, at + max_rows if max_rows else n)))
        at = out[-1][1]
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the row of each; words end with their row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~_IS_SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = word[:-1]
    rows = offsets[:-1][offsets[:-1] < len(data)]
    before[rows] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = word[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_POWERS = {}


def powers(n: int, base: int) -> np.ndarray:
    """``base ** i`` modulo 2 ** 64 for i below ``n``."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        out = np.ones(size, np.uint64)
        out[1:] = base
        _POWERS[base] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[base]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word: a polynomial over its bytes, then ``mix``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.arange(int(lengths.sum()))
    first = np.cumsum(lengths) - lengths
    place = at - np.repeat(first, lengths)
    chars = data[np.repeat(starts, lengths) + place]
    if lower:
        chars = LOWER[chars]
    weighted = (chars.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()), 0x9E3779B97F4A7C15)[place]
    return mix(np.add.reduceat(weighted, first) + lengths.astype(np.uint64))
