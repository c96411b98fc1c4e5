"""Encoding and decoding with a merge-type SentencePiece vocabulary.

Method: merge-type prefix table. The encoding of each prefix of a text has one
last token. For every prefix, an automaton over the pieces lists the pieces
that end there; the last token is the one that may stand after the last token
of the prefix before it. Two tokens may stand side by side if merging their
joined text gives these two tokens again (a pair test, remembered per pair).
The ids are recovered backwards through the table.

No piece holds a word mark after another character, so texts are cut before
word marks, and around characters that no piece holds (these become byte
tokens). Each such chunk is encoded once per Python worker while it stays in a
bounded cache; longer chunks than LONG_CHUNK are not kept. One pass over the
input, no shuffle.

Defined results: a null text is the empty text; an empty text has the end id
alone and decodes to the empty text; a null id stays null; repeated rows are
encoded each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import filled

MARK = "▁"  # the word mark
LONG_CHUNK = 128  # characters; longer chunks are not remembered
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceCodec:
    """The vocabulary of one model file with its prefix-table encoder."""

    def __init__(self, path: str, cache: int = 350_000):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end_id = model.eos_id()
        self.pieces: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.bytes_of: dict[int, int] = {}
        self.byte_id: dict[int, int] = {}
        self.text_of: dict[int, str] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.bytes_of[i] = i, value
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece], self.rank[piece], self.text_of[i] = i, model.get_score(i), piece
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece holds a word mark after another character")
        self.chars = {c for p in self.pieces for c in p}
        self.automaton = ahocorasick.Automaton()
        self.width = model.get_piece_size()
        self.size_of = {i: len(p) for i, p in self.text_of.items()}
        self.pairs: dict[int, bool] = {}  # by left * width + right
        self.cache_size = cache
        self.cache: dict[str, str] = {}  # ids of a chunk as text
        self.before: dict[str, str] = {}
        self.id_text = [str(i) for i in range(self.width)]
        self.neighbours = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.single = {p: i for p, i in self.pieces.items() if len(p) == 1}
        self.odd: dict[str, str] = {}  # decoded text of the chunks that don't come back as they were
        for p, i in self.pieces.items():
            if self.merge(p) == [p]:  # others never come out
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.line_break = "\n" not in self.chars

    def merge(self, text: str) -> list[str]:
        """Merges the best-scored neighbours, leftmost first, until none can merge.

        Only for the texts of one or two pieces (the pair test)."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: int, right: int) -> bool:
        """Whether the piece ``right`` may follow the piece ``left`` (remembered)."""
        if len(self.pairs) >= 1_000_000:
            self.pairs.clear()
        a, b = self.text_of[left], self.text_of[right]
        known = self.pairs[left * self.width + right] = self.merge(a + b) == [a, b]
        return known

    def _table(self, text: str) -> list[int]:
        """Ids of a text whose characters all stand in the vocabulary."""
        last = [-1] * (len(text) + 1)
        known, width = self.pairs.get, self.width
        for end, (piece, size) in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                before = end - size
                if before:
                    left = last[before]
                    if left < 0:
                        continue
                    fits = known(left * width + piece)
                    if not (self.fit(left, piece) if fits is None else fits):
                        continue
                last[end] = piece
        out, at, size_of = [], len(text), self.size_of
        while at:
            out.append(last[at])
            at -= size_of[last[at]]
        return out[::-1]

    def _chunk_ids(self, chunk: str) -> list[int]:
        if self.chars.issuperset(chunk):
            return self._table(chunk)
        ids: list[int] = []
        at = 0
        while at < len(chunk):
            end = at
            while end < len(chunk) and chunk[end] in self.chars:
                end += 1
            if end > at:
                ids.extend(self._table(chunk[at:end]))
            if end < len(chunk):
                ids.extend(self.byte_id[b] for b in chunk[end].encode())
                end += 1
            at = end
        return ids

    def _ids_text(self, chunk: str) -> str:
        """Ids of a chunk as text; short ones remembered, with the decoded text where it isn't the chunk's."""
        out = self.before.get(chunk)
        if out is None:
            end = len(chunk)
            while end > 1 and chunk[end - 2 : end] not in self.neighbours and chunk[end - 1] in self.single:
                end -= 1  # no piece reaches across: the last characters are tokens of their own
            if end < len(chunk):
                head = chunk[:end]
                tail = " ".join([self.id_text[self.single[c]] for c in chunk[end:]])
                out = f"{self.cache.get(head) or self._ids_text(head)} {tail}"
                if head in self.odd:
                    self.odd[chunk] = self.odd[head] + chunk[end:].replace(MARK, " ")
            else:
                ids = self._chunk_ids(chunk)
                out = " ".join([self.id_text[i] for i in ids])
                if "".join([self.text_of.get(i, "") for i in ids]) != chunk:
                    decoded = self._decode_raw(ids)
                    if decoded != chunk.replace(MARK, " "):
                        self.odd[chunk] = decoded
        if len(chunk) > LONG_CHUNK:
            return out
        if len(self.cache) >= self.cache_size:  # the last two generations are kept
            self.before, self.cache = self.cache, {}
        self.cache[chunk] = out
        return out

    def _decode_raw(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in ids:
            if i in self.bytes_of:
                run.append(self.bytes_of[i])
            else:
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run.clear()
                out.append(self.text_of.get(i, ""))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")

    def chunks(self, text: str) -> list[str]:
        """The text with word marks, cut where no piece can reach across."""
        if not text:
            return []
        out: list[str] = []
        lines = text.split("\n") if self.line_break else [text]
        for k, line in enumerate(lines):
            if k:
                out.append("\n")
            words = line.split(" ")
            if MARK in line or "" in words:
                marked = line.replace(" ", MARK)
                out += re.findall(f"{MARK}+[^{MARK}]*|^[^{MARK}]+", marked if k else MARK + marked)
                continue
            if k:
                out.append(words[0])
                out += [MARK + w for w in words[1:]]
            else:
                out += [MARK + w for w in words]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids without the end id."""
        return [i for c in self.chunks(text) for i in self._chunk_ids(c)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the mark that encoding puts before a text is taken off."""
        text = self._decode_raw([i for i in ids if i != self.end_id])
        return text[1:] if text.startswith(" ") else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids with the end id, hash of the ids, hash of the decoded text."""
        if len(self.odd) >= self.cache_size:
            self.cache, self.before, self.odd = {}, {}, {}
        chunks = self.chunks(text)
        ids = " ".join([self.cache.get(c) or self._ids_text(c) for c in chunks] + [str(self.end_id)])
        if self.odd:
            decoded = "".join([self.odd.get(c, c) for c in chunks]).replace(MARK, " ")
        else:
            decoded = "".join(chunks).replace(MARK, " ")
        decoded = decoded[1:] if decoded.startswith(" ") else decoded
        sha = hashlib.sha256
        return ids.count(" ") + 1, sha(ids.encode()).hexdigest(), sha(decoded.encode()).hexdigest()


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of a model file, built once a Python worker."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids): the ids of every whole text with the end id."""

    def run(batches):
        c = codec(model_path)
        for batch in batches:
            ids = [c.encode(t.as_py()) + [c.end_id] for t in filled(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _read(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """Rows (doc_id, text) of rows (doc_id, ids)."""

    def run(batches):
        c = codec(model_path)
        for batch in batches:
            texts = [c.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SCHEMA: encodes every whole text, decodes the ids, keeps their hashes."""

    def run(batches):
        c = codec(model_path)
        for batch in batches:
            rows = [c.digest(t.as_py()) for t in filled(batch.column(1))]
            n, ids, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _read(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
