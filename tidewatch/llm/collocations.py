"""Phrase collocations with mergeable Misra-Gries summaries per hash partition.

Rule (all integers; everything per language, null is ``und``). A-Z are
lower-cased, texts are split at ``SEPARATORS`` into pieces and these at blanks
into words. n is the number of words, f(phrase) that of its contiguous
occurrences within pieces. Candidates are the phrases of 2 to 5 words with
a = f >= ``min_count``. A cut after k words gives l and r, the f of its parts,
and the score floor(1000 * a * n / (l * r)); the lowest counts, ties to the
smallest k. A candidate goes when a longer one with as many occurrences holds
its words (it then has a neighbour one word longer with as many, so only these
are looked at). The first ``top`` by score, a (both descending) and bytes stay.

Method. Words are counted exactly. A pass over the texts then hashes the
n-grams (``lengths``) whose parts survived before, and sums them within the
task; the sums go to hash partitions. A partition keeps a Misra-Gries summary:
at most ``mass / min_count + 1`` counters, and what is over is met by lowering
all counters, which costs any n-gram less than ``min_count`` in total. Summaries
merge by adding and lowering, so every n-gram with ``min_count`` occurrences
survives. Survivors (those whose counter and loss reach the threshold) are set
as bits of a filter. There are two such passes, for pairs and for 3 to 5 words,
and a last pass counts the words of all survivors exactly, as strings: a hash
only ever lets too much through.

Memory: a task holds bounded arrays, a summary ``mass / (parts * min_count)``
counters (``parts`` grows with the mass), the filter 16 bits per survivor and
at most ``MAX_BITS``, 64 MB; with more survivors than that it lets more n-grams
through to the exact count, which is an aggregate by shuffle. Texts longer than
a slice are cut after a separator, where no phrase goes on.

Defined results: null and empty texts have no words; a language without a
candidate has no rows; repeated rows count each; ties as above; very long texts
are read whole; an empty table gives no rows; only text and language are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.operators.common import checked_broadcast
from tidewatch.session import scratch_dir

from .arrow_text import flat_bytes, mix, word_hashes
from .word_codes import Tally, byte_class, coded_words, counted, cut_slices

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LONGEST = 5
MIN_COUNT = 100
TOP = 2000
MAX_BITS = 1 << 29
PART_COUNTERS = 1 << 19
_CUT = byte_class(SEPARATORS)
_IS_WORD = ~byte_class(SEPARATORS + BLANKS)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Bits:
    """Set of hashes as a bit table of 2 ** ``power`` places; answers yes for every member."""

    def __init__(self, power: int, table: np.ndarray):
        self.power, self.table = power, table

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - self.power)
        return (self.table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bit_table(hashes: DataFrame, column: str, spare: int = 16) -> Bits:
    """The filter of a stored column of hashes: bits are set by a Spark aggregate, the driver gets at most MAX_BITS of them."""
    n = hashes.count()
    power = min(MAX_BITS.bit_length() - 1, max(16, (n * spare).bit_length()))
    place = F.shiftrightunsigned(column, 64 - power) + 1  # places start at 1, as bitmap buckets do
    blocks = (
        hashes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    )
    table = np.zeros(1 << (power - 3), np.uint8)
    for row in blocks:
        own = np.frombuffer(row.bits, np.uint8)
        at = (row.b - 1) * len(own)
        table[at : at + len(own)] = own[: len(table) - at]
    return Bits(power, table)


def lang_hash(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


class Slice:
    """Words of a slice of texts with their hashes, and which follow each other within a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, salts: np.ndarray):
        w = coded_words(data, offsets, _IS_WORD)
        chars, off = w.flat()
        self.words, self.code, self.lang = w.words, w.code, lang[w.row]
        hashes = word_hashes(chars, off[:-1], off[1:], lower=False)
        self.hash = mix(hashes[w.code] + salts[self.lang]) if len(w.code) else np.zeros(0, np.uint64)
        piece = np.cumsum(_CUT[data], dtype=np.int64)[w.start] if len(w.start) else w.start
        self.joined = (w.row[1:] == w.row[:-1]) & (piece[1:] == piece[:-1])

    def grams(self, known: Bits, pairs: Bits | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, first places, hashes) of the n-grams that can be frequent: pairs of known words, then 3 to 5 words of known pairs."""
        ok = known.has(self.hash)
        at = np.flatnonzero(ok[:-1] & ok[1:] & self.joined)
        h = self._longer(self.hash, at, 1)
        if pairs is None:
            yield 2, at, h
            return
        hit = pairs.has(h)
        at, h = at[hit], h[hit]
        yield 2, at, h
        starts = np.zeros(len(self.hash), bool)
        starts[at] = True
        chain = np.zeros(len(self.hash), np.uint64)
        for k in range(3, LONGEST + 1):
            chain[at] = h
            at = at[starts[np.minimum(at + k - 2, len(starts) - 1)] & (at + k <= len(starts))]
            h = self._longer(chain, at, k - 1)
            yield k, at, h

    def _longer(self, chain: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the n-grams at ``at`` with their word ``k`` more."""
        return mix(chain[at] * _STEP + self.hash[at + k]) if len(at) else np.zeros(0, np.uint64)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[Slice, pa.Array]]:
    lang = pc.fill_null(batch.column("lang").cast(pa.string()), "und").dictionary_encode()
    code = lang.indices.to_numpy().astype(np.int64)
    salts = np.array([lang_hash(x) for x in lang.dictionary.to_pylist()], np.uint64)
    data, off = flat_bytes(batch.column("text"))
    for row, own, local in cut_slices(data, off, _CUT):
        s = Slice(own, local, code[row:], salts)
        if len(s.code):
            yield s, lang.dictionary


def _strings(langs: pa.Array, lang: np.ndarray, words: list[pa.Array], n: np.ndarray) -> pa.Table:
    words = [w.cast(pa.string()) for w in words]
    phrase = words[0] if len(words) == 1 else pc.binary_join_element_wise(*words, " ")
    return pa.table({
        "lang": langs.take(pa.array(lang)), "size": pa.array(np.full(len(n), len(words)), pa.int32()), "phrase": phrase, "f": pa.array(n, pa.int64())
    })


def _word_counts(batches):
    tally = Tally(["lang", "size", "phrase"], ["f"])
    for batch in batches:
        for s, langs in _slices(batch):
            wide = len(s.words)
            keys, n = counted(s.lang * wide + s.code)
            yield from tally.add(_strings(langs, keys // wide, [s.words.take(pa.array(keys % wide))], n))
    yield from tally.rest()


def _exact_counts(known, pairs, longer):
    """Counts of the phrases behind the survivors' hashes, by the words themselves."""

    def run(batches):
        tally = Tally(["lang", "size", "phrase"], ["f"])
        for batch in batches:
            for s, langs in _slices(batch):
                wide = len(s.words)
                for k, at, h in s.grams(known.value, pairs.value):
                    if k > 2:
                        at = at[longer.value.has(h)]
                    ids = s.lang[at]
                    for j in range(k):  # distinct word sequences, numbered word by word
                        _, ids = np.unique(ids * wide + s.code[at + j], return_inverse=True)
                    _, first, n = np.unique(ids, return_index=True, return_counts=True)
                    at = at[first]
                    if len(at):
                        yield from tally.add(_strings(langs, s.lang[at], [s.words.take(pa.array(s.code[at + j])) for j in range(k)], n))
        yield from tally.rest()

    return run


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition, in the order of the hashes."""
    return ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counters of equal keys added."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    return keys[first], (np.add.reduceat(counts, first) if len(keys) else counts)


class Summary:
    """Misra-Gries counters: a key's count is at most ``loss`` below its true sum, and ``loss`` stays below mass / capacity."""

    def __init__(self, capacity: int):
        self.capacity, self.loss = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting, self.size = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Another summary of the same partition."""
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > max(self.capacity, 1 << 15):
            self.merge()

    def merge(self) -> None:
        parts = [(self.keys, self.counts), *self.waiting]
        self.keys, self.counts = merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        self.waiting, self.size = [], 0
        if len(self.keys) > self.capacity:
            over = len(self.keys) - self.capacity - 1
            least = int(np.partition(self.counts, over)[over])  # the largest count that leaves at most ``capacity`` above it
            left = self.counts > least
            self.keys, self.counts, self.loss = self.keys[left], self.counts[left] - least, self.loss + least

    def survivors(self, threshold: int) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.loss >= threshold]


def count_type(min_count: int) -> np.dtype:
    """Smallest type of the counts that tasks send."""
    return np.min_scalar_type(2 * min_count)


def _summaries(known, pairs, parts: int, min_count: int, limit: int = 2_000_000):
    """Rows of a task's summaries: first the mass (kind 0), then the counters (kind 1) of each hash partition it met."""
    clip = 2 * min_count  # a count of that much survives whatever is lowered

    def run(batches):
        held = [], []
        raw, size = [], 0

        def fold(raw, held):
            keys, n = counted(np.concatenate(raw)) if raw else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            keys, n = merged(np.concatenate([*held[0], keys]), np.concatenate([*held[1], n]))
            return keys, n

        def rows(keys, n):
            n = np.minimum(n, clip)
            part = part_of(keys, parts)
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            ends = np.append(first[1:], len(part))
            own = part[first]
            mass = np.add.reduceat(n, first)
            none = pa.nulls(len(own), pa.binary())
            yield pa.record_batch([pa.array(own), pa.array(np.zeros(len(own), np.int32)), pa.array(mass), none, none], names)
            n = n.astype(count_type(min_count))
            for a in range(0, len(own), 512):
                at = list(zip(first[a : a + 512], ends[a : a + 512], strict=True))
                yield pa.record_batch(
                    [pa.array(own[a : a + 512]), pa.array(np.ones(len(at), np.int32)), pa.array(mass[a : a + 512]),
                     pa.array([keys[i:j].tobytes() for i, j in at], pa.binary()), pa.array([n[i:j].tobytes() for i, j in at], pa.binary())], names)

        names = ["part", "kind", "mass", "keys", "counts"]
        for batch in batches:
            for s, _ in _slices(batch):
                for k, _, h in s.grams(known.value, pairs.value if pairs else None):
                    if pairs is None or k > 2:
                        raw.append(h)
                        size += len(h)
                if size > limit:
                    keys, n = fold(raw, held)
                    held, raw, size = ([keys], [n]), [], len(keys) // 2
                    if len(keys) > limit:
                        yield from rows(keys, n)
                        held, size = ([], []), 0
        if raw or held[0]:
            keys, n = fold(raw, held)
            if len(keys):
                yield from rows(keys, n)

    return run


def _survivors(min_count: int):
    def run(batches):
        part, mass, summary = None, 0, None

        def done():
            if summary is not None:
                keys = summary.survivors(min_count)
                yield pa.record_batch([pa.array(keys.view(np.int64))], ["h"])

        for batch in batches:
            cols = [batch.column(c) for c in ("part", "kind", "mass")]
            for i, (p, kind, m) in enumerate(zip(*(c.to_pylist() for c in cols), strict=True)):
                if p != part:
                    yield from done()
                    part, mass, summary = p, 0, None
                if kind == 0:
                    mass += m
                    continue
                if summary is None:
                    summary = Summary(mass // min_count + 1)
                summary.add(
                    np.frombuffer(batch.column("keys")[i].as_buffer(), np.uint64),
                    np.frombuffer(batch.column("counts")[i].as_buffer(), count_type(min_count)).astype(np.int64),
                )
        yield from done()

    return run


def frequent_hashes(texts: DataFrame, words: int, known, pairs, min_count: int) -> DataFrame:
    """(h): hashes of all n-grams with ``min_count`` occurrences, and of some others: two merging steps of summaries."""
    shuffles = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(2048, 4 * shuffles, words * LONGEST // (min_count * PART_COUNTERS))
    local = texts.mapInArrow(_summaries(known, pairs, parts, min_count), "part long, kind int, mass long, keys binary, counts binary")
    return local.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(_survivors(min_count), "h long")


def _hashed(batches):
    """Hash of each (lang, phrase) of one word, as the slices have it."""
    for batch in batches:
        data, off = flat_bytes(batch.column("phrase"))
        salt = np.array([lang_hash(x) for x in batch.column("lang").to_pylist()], np.uint64)
        h = mix(word_hashes(data, off[:-1], off[1:], lower=False) + salt) if batch.num_rows else salt
        yield pa.record_batch([pa.array(h.view(np.int64))], ["h"])


def phrase_counts(docs: DataFrame, text_col: str, lang_col: str, min_count: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored (lang, n) and (lang, size, phrase, f) of all words and phrases with ``min_count`` occurrences."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    schema = "lang string, size int, phrase string, f long"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))

    every = stored(summed(texts.mapInArrow(_word_counts, schema)), "words")
    totals = stored(every.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = every.filter(F.col("f") >= min_count)
    mass = totals.agg(F.sum("n")).first()[0] or 0
    share = spark.sparkContext.broadcast
    known = share(bit_table(stored(words.mapInArrow(_hashed, "h long"), "word_hashes"), "h"))
    pairs = share(bit_table(stored(frequent_hashes(texts, mass, known, None, min_count), "pair_hashes"), "h"))
    longer = share(bit_table(stored(frequent_hashes(texts, mass, known, pairs, min_count), "longer_hashes"), "h"))
    phrases = summed(texts.mapInArrow(_exact_counts(known, pairs, longer), schema)).filter(F.col("f") >= min_count)
    return totals, stored(words.unionByName(phrases), "frequent")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` collocations of every language."""
    folder = scratch_dir(docs.sparkSession, f"collocations-{uuid.uuid4().hex}")
    totals, frequent = phrase_counts(docs, text_col, lang_col, min_count, folder)
    part = lambda side: frequent.select("lang", F.col("phrase").alias(f"{side}_part"), F.col("f").alias(side))
    found = frequent.filter("size > 1").withColumn("w", F.split("phrase", " ")).withColumnRenamed("f", "a")
    cuts = found.select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("l_part"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("r_part"),
    )
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    thousand = (F.col("a") * 1000).cast("decimal(19,0)")
    scored = (
        cuts.join(part("l"), ["lang", "l_part"]).join(part("r"), ["lang", "r_part"]).join(checked_broadcast(totals), "lang")
        .withColumn("score", F.call_function("div", thousand * wide("n"), wide("l") * wide("r")))
        .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    )
    ends = F.array(
        F.array_join(F.slice("w", F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice("w", F.lit(2), F.col("size") - 1), " ")
    )
    inside = found.filter("size > 2").select("lang", F.explode(ends).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    return left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
        F.col("best.score").alias("score"),
    )
