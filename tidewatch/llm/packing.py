"""Packing of tokenised documents into sequences of several context sizes.

Method: hierarchical multi-length packing. Each document is cut into full
windows and a remainder; the remainder is routed to the tier of the smallest
power of two that holds it. Long windows start with a piece of the highest
tier and their gap is filled from shorter tiers, largest fitting piece first;
when none fits, a short piece is cut. What is left of an input partition goes
out in shorter windows (powers of two), so nothing is padded. Sequences are
dealt to step groups so that the attention cost of the groups is balanced.

All of it is one pass over the input: no shuffle and no second tokenisation.
A task buffers at most ``buffer`` remainders (each below one window).
Sequence and step ids hold the number of the input partition in the high bits,
so they are unique without coordination; ``docs`` should be a scan (or a table
written before), whose partitions come out alike when a task runs again.

Defined results: a null text is the empty text, an empty text is the closing
id alone, a null id stays null, repeated rows are packed each, an empty table
gives no pieces; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import filled

WINDOW = 1024
END_ID = 0
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_id long"
)
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
_TYPES = [pa.int32() if f.endswith(" int") else pa.int64() for f in SCHEMA.split(", ")]
_ENCODERS: dict[tuple, object] = {}


def added_tokens(path: str) -> dict[str, int]:
    """Text and id of the tokens that a ``tokenizers`` file adds to its vocabulary; these are found in text as they stand."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens):
        raise ValueError("an added token is not matched literally")
    return {t["content"]: t["id"] for t in tokens}


def encoder(path: str, pattern: str, added: dict[str, int] | None = None):
    """Function from text to ids by the byte-level BPE of the rank file, built once a Python worker."""
    added = added or {}
    key = (path, pattern, *sorted(added.items()))
    if key not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

        def encode(text: str) -> list[int]:
            if any(t in text for t in added):
                return encoding.encode(text, allowed_special="all", disallowed_special=())
            return encoding.encode_ordinary(text)

        _ENCODERS[key] = encode
    return _ENCODERS[key]


def tier_of(length: int, window: int = WINDOW) -> int:
    """Smallest power of two that holds ``length`` tokens, at most the window."""
    return min(window, 1 << max(0, (length - 1).bit_length()))


class Packer:
    """Packs the pieces of one input partition.

    Pieces are tuples (document, start, ids, tokens of the document).
    """

    def __init__(self, partition: int, window: int = WINDOW, buffer: int = 2048, step: int = 64):
        self.window, self.buffer, self.step = window, buffer, step
        self.base = partition << 40
        self.sequences = self.steps = self.pending = 0
        self.tiers: dict[int, dict[int, list]] = {}  # tier -> length -> pieces
        self.ready: list[list] = []  # finished sequences
        self.rows: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        n = len(ids)
        full = n - n % self.window
        for at in range(0, full, self.window):
            self.ready.append([(doc, at, ids[at : at + self.window], n)])
        if full < n:
            self._keep((doc, full, ids[full:], n))
        if self.pending >= self.buffer or len(self.ready) >= self.buffer:
            self._fill(self.buffer // 4)
            self._emit()

    def _keep(self, piece) -> None:
        length = len(piece[2])
        self.tiers.setdefault(tier_of(length, self.window), {}).setdefault(length, []).append(piece)
        self.pending += 1

    def _take(self, tier: int, length: int):
        lengths = self.tiers[tier]
        piece = lengths[length].pop()
        if not lengths[length]:
            del lengths[length]
            if not lengths:
                del self.tiers[tier]
        self.pending -= 1
        return piece

    def _fitting(self, gap: int):
        """The largest piece of at most ``gap`` tokens, from the highest tier that has one."""
        for tier in sorted(self.tiers, reverse=True):
            if tier >= 2 * gap and tier > 1:
                continue
            lengths = sorted(self.tiers[tier])
            at = bisect.bisect_right(lengths, gap)
            if at:
                return self._take(tier, lengths[at - 1])
        return None

    def _fill(self, leave: int) -> None:
        """Fill long windows until ``leave`` pieces or less than a window are left."""
        tokens = sum(n * len(x) for t in self.tiers.values() for n, x in t.items())
        while self.pending > leave and tokens >= self.window:
            top = max(self.tiers)
            piece = self._take(top, max(self.tiers[top]))
            sequence, gap = [piece], self.window - len(piece[2])
            while gap:
                piece = self._fitting(gap)
                if piece is None:  # all that is left is longer than the gap: cut the shortest
                    low = min(self.tiers)
                    doc, start, ids, n = self._take(low, min(self.tiers[low]))
                    piece = (doc, start, ids[:gap], n)
                    self._keep((doc, start + gap, ids[gap:], n))
                sequence.append(piece)
                gap -= len(piece[2])
            self.ready.append(sequence)
            tokens -= self.window

    def finish(self) -> None:
        """Pack what is left: long windows first, then one window of each shorter size needed."""
        self._fill(0)
        rest = sorted(
            (p for t in self.tiers.values() for x in t.values() for p in x), key=lambda p: -len(p[2])
        )
        self.tiers, self.pending = {}, 0
        left = sum(len(p[2]) for p in rest)
        while left:
            size = 1 << (left.bit_length() - 1)
            sequence, gap = [], size
            while gap:
                doc, start, ids, n = rest.pop(0)
                if len(ids) > gap:
                    rest.insert(0, (doc, start + gap, ids[gap:], n))
                    ids = ids[:gap]
                sequence.append((doc, start, ids, n))
                gap -= len(ids)
            self.ready.append(sequence)
            left -= size
        self._emit()

    def _emit(self) -> None:
        """Write the finished sequences, dealt to step groups of alike attention cost."""
        cost = [sum(len(p[2]) ** 2 for p in s) for s in self.ready]
        order = sorted(range(len(cost)), key=lambda i: (-cost[i], i))
        groups = -(-len(cost) // self.step)
        group = {}
        for rank, i in enumerate(order):  # back and forth over the groups
            turn, at = divmod(rank, groups)
            group[i] = at if turn % 2 == 0 else groups - 1 - at
        for i, sequence in enumerate(self.ready):
            tier, offset = tier_of(sum(len(p[2]) for p in sequence), self.window), 0
            for doc, start, ids, n in sequence:
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                self.rows.append(
                    (doc, start, len(ids), crc, n, self.base + self.sequences, offset, tier,
                     self.base + self.steps + group[i])
                )
                offset += len(ids)
            self.sequences += 1
        self.steps += groups
        self.ready = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(_NAMES)
        self.rows = []
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def pack(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    buffer: int = 2048,
    step: int = 64,
    added: dict[str, int] | None = None,
) -> DataFrame:
    """One row per piece of every document; see the module's text.

    ``ranks_path`` is the vocabulary of the byte-level BPE as a rank file and
    must exist on every executor; ``pattern`` is its splitting rule. ``added``
    are the tokens outside the ranks that stand in texts literally (see
    ``added_tokens``).
    """

    def run(batches):
        encode = encoder(ranks_path, pattern, added)
        context = TaskContext.get()
        packer = Packer(context.partitionId() if context else 0, window, buffer, step)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = filled(batch.column(1))
            for k, doc in enumerate(ids):
                tokens = encode(texts[k].as_py())
                tokens.append(END_ID)
                packer.add(doc, np.array(tokens, np.uint32))
                if len(packer.rows) >= 20_000:
                    yield packer.batch()
        packer.finish()
        yield packer.batch()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, SCHEMA
    )
