"""Words of Arrow batches as integer codes of an exact dictionary, and bounded tallies of strings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .arrow_text import LOWER

SLICE_BYTES = 1 << 22


def byte_class(members: bytes) -> np.ndarray:
    """Table over all byte values: True for ``members``."""
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


@dataclass
class Words:
    """Words in text order: row, first byte, code; ``words`` holds the bytes of each code."""

    row: np.ndarray
    start: np.ndarray
    code: np.ndarray
    words: pa.Array

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the dictionary in one array, and its offsets."""
        _, offsets, data = self.words.buffers()
        off = np.frombuffer(offsets, np.int64)[self.words.offset : self.words.offset + len(self.words) + 1]
        if data is None or not len(self.words):
            return np.zeros(0, np.uint8), np.zeros(len(self.words) + 1, np.int64)
        return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def coded_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of ``is_word`` bytes within rows, A-Z lower-cased, as codes of a dictionary of the call."""
    inside = is_word[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    first = offsets[:-1]
    before[first[first < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    chars = LOWER[data[inside]]
    # A word's place among the kept bytes: kept bytes before its start.
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=kept[1:])
    ends = np.append(kept[start], len(chars))
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(chars)])
    coded = array.dictionary_encode()
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(row, start, coded.indices.to_numpy().astype(np.int64), coded.dictionary)


def cut_slices(data: np.ndarray, offsets: np.ndarray, cut: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, local offsets) of about ``size`` bytes; a longer row is cut after a ``cut`` byte."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        lo, hi = int(offsets[at]), int(offsets[end])
        while end == at + 1 and hi - lo > size:
            found = np.flatnonzero(cut[data[lo : lo + size]])
            step = size
            while not len(found) and lo + step < hi:
                found = np.flatnonzero(cut[data[lo + step : lo + step + size]])[:1] + step
                step += size
            if not len(found):
                break
            to = lo + int(found[-1]) + 1
            yield at, data[lo:to], np.array([0, to - lo])
            lo = to
        yield at, data[lo:hi], (offsets[at : end + 1] - lo) if end > at + 1 else np.array([0, hi - lo])
        at = end


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


class Tally:
    """Sums per key of Arrow tables, held to about ``limit`` rows: partial sums go out beyond it."""

    def __init__(self, keys: list[str], sums: list[str], limit: int = 400_000):
        self.keys, self.sums, self.limit = keys, sums, limit
        self.parts, self.size = [], 0

    def _folded(self) -> pa.Table:
        table = pa.concat_tables(self.parts)
        out = table.group_by(self.keys, use_threads=False).aggregate([(s, "sum") for s in self.sums])
        return out.select(self.keys + [f"{s}_sum" for s in self.sums]).rename_columns(self.keys + self.sums)

    def add(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        self.parts.append(table)
        self.size += len(table)
        if self.size > self.limit:
            folded = self._folded()
            self.parts, self.size = [folded], len(folded)
            if self.size > self.limit // 2:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            yield from self._folded().to_batches(max_chunksize=50_000)
        self.parts, self.size = [], 0
