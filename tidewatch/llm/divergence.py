"""Source divergence audit with a frequent-pattern tree of term rows.

Rule (all integers). Terms are the maximal runs of ASCII letters and non-ASCII
characters, A-Z lower-cased. Each language keeps the V terms that at least
``min_docs`` of its documents hold. A (language, source) group, and the
language as a whole, gives a kept term with ``count`` occurrences
p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)), N the group's
occurrences of kept terms. Part ``pair``: the sum of abs(p - q) over the kept
terms for every two sources of a language. Part ``term``: the terms of a group
with count > 0 whose p is above the language's, by the difference.

Method. A kept term's row is its nonzero counts in source order, sources with
more terms first. The distance of two sources starts as if neither had any
term: V * abs(b - b'), b a source's p at count 0. What a nonzero count changes
against a source without the term comes from the histogram of each source's p.
What two nonzero counts of a term change beyond that is the pair correction.
Equal rows are counted first, then inserted with their multiplicity into a
frequent-pattern tree, a path per row; a correction depends on the two counts
alone, so it is computed once per node and ancestor, times the node's
multiplicity. A task holds the path it is at (rows come sorted) and a bounded
list of corrections; the tree is cut into ranges of paths, which only splits a
border node's multiplicity.

Skew: occurrences are summed within tasks before any shuffle; rows are dealt by
ranges of distinct paths, so neither a hot source nor a frequent pattern lands
in one task. A row has at most one entry per source of its language, and the
answer itself has a row for every two sources of it. A histogram of a source
has at most sqrt(2 * (SCALE + V)) entries, as its p add up to SCALE + V.

Defined results: null text, lang and source are ''; a group without terms has
counts of 0; a language without kept terms has pairs with value 0 and no terms;
equal values rank by the item's bytes; repeated rows count each; very long
texts are read whole (a text is handled in one piece); an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.common import checked_broadcast
from tidewatch.session import scratch_dir

from .arrow_text import filled, flat_bytes, row_slices
from .word_codes import SLICE_BYTES, Tally, byte_class, coded_words, counted

SCALE = 1_000_000_000
SMOOTH = 5
MIN_DOCS = 30
TOP_TERMS = 50
TERM_BYTES = byte_class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))


def _as_string(values: pa.Array) -> pa.Array:
    return values.cast(pa.string())


def _occurrences(batches):
    """Partial (lang, source, term, n, docs); a null term stands for the group itself."""
    tally = Tally(["lang", "source", "term"], ["n", "docs"])
    for batch in batches:
        lang, source = (filled(batch.column(c)).dictionary_encode() for c in ("lang", "source"))
        wide = len(source.dictionary)
        group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()

        def rows(keys, term, n, docs):
            return pa.table({
                "lang": _as_string(lang.dictionary.take(pa.array(keys // wide))), "source": _as_string(source.dictionary.take(pa.array(keys % wide))),
                "term": term, "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64()),
            })

        seen, _ = counted(group)
        yield from tally.add(rows(seen, pa.nulls(len(seen), pa.string()), seen * 0, seen * 0))
        data, off = flat_bytes(batch.column("text"))
        for a, b in row_slices(off, SLICE_BYTES):
            w = coded_words(data[off[a] : off[b]], off[a : b + 1] - off[a], TERM_BYTES)
            size = len(w.words)
            if not size:
                continue
            of_row = group[a:b]
            held, times = counted(w.row * size + w.code)  # (document, term)
            keys = of_row[held // size] * size + held % size
            order = np.argsort(keys, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(keys[order]) > 0))
            own = keys[order][first]
            yield from tally.add(
                rows(own // size, _as_string(w.words.take(pa.array(own % size))), np.add.reduceat(times[order], first), np.diff(np.append(first, len(keys))))
            )
    yield from tally.rest()


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, its size then known to the planner."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _p(count: Column, total: Column, kept: Column, smooth: int, scale: int) -> Column:
    """The smoothed share as an exact integer; null without kept terms."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (wide(count) + F.lit(smooth).cast("decimal(10,0)")) * F.lit(scale).cast("decimal(10,0)")
    under = (wide(total) + wide(kept) * F.lit(smooth).cast("decimal(10,0)"))
    return F.when(kept > 0, F.call_function("div", top, F.when(kept > 0, under)) + F.lit(1))


class PathTree:
    """Pair corrections of sorted paths: one per node and ancestor, when the walk leaves the node."""

    def __init__(self, limit: int = 500_000):
        self.lang, self.path, self.weight = None, np.zeros((0, 4), np.int64), []
        self.found, self.size, self.limit = [], 0, limit

    def _leave(self, depth: int) -> None:
        """Close the nodes below ``depth``; their multiplicity belongs to their parents too."""
        path = self.path
        for at in range(len(path) - 1, depth - 1, -1):
            m = self.weight[at]
            if at:
                above = path[:at]
                _, _, p, b = path[at]
                fix = m * (np.abs(p - above[:, 2]) - np.abs(p - above[:, 3]) - np.abs(b - above[:, 2]) + np.abs(b - above[:, 3]))
                self.found.append((above[:, 0], np.full(at, path[at, 0]), fix))
                self.size += at
                self.weight[at - 1] += m
        del self.weight[depth:]

    def _summed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lo, hi, fix = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.lexsort((hi, lo))
        lo, hi, fix = lo[order], hi[order], fix[order]
        first = np.flatnonzero(np.append(True, (np.diff(lo) != 0) | (np.diff(hi) != 0)))
        return lo[first], hi[first], np.add.reduceat(fix, first)

    def flush(self):
        """Partial sums of the corrections found so far."""
        if self.found:
            lo, hi, fix = self._summed()
            yield pa.record_batch(
                [pa.array([self.lang] * len(lo), pa.string()), pa.array(lo), pa.array(hi), pa.array(fix)], ["lang", "lo", "hi", "v"]
            )
        self.found, self.size = [], 0

    def insert(self, lang: str, path: np.ndarray, times: int):
        """The next path in order: rows (source, count, p, base)."""
        if lang != self.lang:
            self._leave(0)
            yield from self.flush()
            self.lang, self.path = lang, path[:0]
        short = min(len(path), len(self.path))
        differ = np.flatnonzero((path[:short, :2] != self.path[:short, :2]).any(1))
        shared = int(differ[0]) if len(differ) else short
        self._leave(shared)
        self.path = path
        self.weight += [0] * (len(path) - shared)
        self.weight[-1] += times
        if self.size > self.limit:
            lo, hi, fix = self._summed()
            self.found, self.size = [(lo, hi, fix)], len(lo)
            if self.size > self.limit // 2:
                yield from self.flush()

    def rest(self):
        self._leave(0)
        yield from self.flush()


def _corrections(batches):
    tree = PathTree()
    for batch in batches:
        paths, times = batch.column("path"), batch.column("m").to_numpy()
        ends = paths.offsets.to_numpy()
        items = paths.flatten()
        base = int(ends[0]) if len(ends) else 0
        values = np.stack([items.field(f).to_numpy() for f in ("g", "n", "p", "b")], 1)
        for i, lang in enumerate(batch.column("lang").to_pylist()):
            yield from tree.insert(lang, values[ends[i] - base : ends[i + 1] - base], int(times[i]))
    yield from tree.rest()


def tree_corrections(rows: DataFrame) -> DataFrame:
    """(lang, lo, hi, v) from term rows (lang, term, g, n, p, b): partial sums per pair of source places."""
    paths = rows.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("g", "n", "p", "b"))).alias("path"))
    distinct = paths.groupBy("lang", "path").agg(F.count("*").alias("m"))
    dealt = distinct.repartitionByRange("lang", F.slice("path", 1, 4), F.xxhash64("path"))  # the sampled key stays short
    return dealt.sortWithinPartitions("lang", "path").mapInArrow(_corrections, "lang string, lo long, hi long, v long")


def _single(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, lo, hi, v): what a source's nonzero counts change against each other source without the term."""
    held = rows.groupBy("lang", "g", "b", "p").agg(F.count("*").alias("m")).select(
        "lang", "g", "b", F.col("p").alias("at"), "m", F.lit(None).cast("long").alias("other")
    )
    other = groups.select("lang", F.col("g").alias("other"), F.col("b").alias("at"))
    asked = groups.select("lang", "g", "b").join(other, "lang").filter("g <> other").select(  # the pairs that the answer lists
        "lang", "g", "b", "at", F.lit(0).cast("long").alias("m"), "other"
    )
    whole = Window.partitionBy("lang", "g")
    upto = whole.orderBy("at", F.col("other").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mass = F.col("m") * F.col("at")
    below, below_sum, all_, all_sum = F.sum("m").over(upto), F.sum(mass).over(upto), F.sum("m").over(whole), F.sum(mass).over(whole)
    moved = F.col("at") * below - below_sum + (all_sum - below_sum) - F.col("at") * (all_ - below) - all_ * F.abs(F.col("b") - F.col("at"))
    return held.unionByName(asked).withColumn("v", moved).filter("other IS NOT NULL").select(
        "lang", F.least("g", "other").alias("lo"), F.greatest("g", "other").alias("hi"), "v"
    )


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_docs: int = MIN_DOCS, smooth: int = SMOOTH, scale: int = SCALE, top: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (language, source) group."""
    folder = scratch_dir(docs.sparkSession, f"divergence-{uuid.uuid4().hex}")
    read = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    counts = (
        read.mapInArrow(_occurrences, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    stored = _stored(
        counts.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("c"), F.sum("docs").alias("docs"))
        .filter(F.col("term").isNull() | (F.col("docs") >= min_docs)),
        folder, "terms",
    )
    terms = stored.filter("term IS NOT NULL")
    lang_n = F.aggregate("c", F.lit(0).cast("long"), lambda x, c: x + c["n"])
    kept = terms.select("lang", "term", lang_n.alias("lang_n"), F.inline("c"))
    by_lang = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum(lang_n).alias("lang_total"))
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    place = Window.partitionBy("lang").orderBy(F.desc("held"), "source")
    named = (
        stored.filter("term IS NULL").select("lang", F.explode("c.source").alias("source"))
        .join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").na.fill(0)
    )
    groups = _stored(
        named.select("lang", "source", "total", "v", "lang_total", (F.row_number().over(place) - 1).cast("long").alias("g"),
                     _p(F.lit(0), F.col("total"), F.col("v"), smooth, scale).alias("b")),
        folder, "groups",
    )

    rows = kept.join(checked_broadcast(groups), ["lang", "source"]).withColumn("p", _p(F.col("n"), F.col("total"), F.col("v"), smooth, scale))
    one, two = (groups.select("lang", F.col("g").alias(g), F.col("b").alias(b), "v") for g, b in (("lo", "b1"), ("hi", "b2")))
    apart = one.join(two.drop("v"), "lang").filter("lo < hi").select("lang", "lo", "hi", F.coalesce(F.col("v") * F.abs(F.col("b1") - F.col("b2")), F.lit(0)).alias("v"))
    pairs = (
        apart.unionByName(_single(rows, groups)).unionByName(tree_corrections(rows))
        .groupBy("lang", "lo", "hi").agg(F.coalesce(F.sum("v"), F.lit(0)).alias("value"))
    )
    both = pairs.select("lang", "value", F.inline(F.array(
        F.struct(F.col("lo").alias("g"), F.col("hi").alias("o")), F.struct(F.col("hi").alias("g"), F.col("lo").alias("o")))))
    names = groups.select("lang", "g", "source")
    pair = (
        both.join(checked_broadcast(names), ["lang", "g"])
        .join(checked_broadcast(names.select("lang", F.col("g").alias("o"), F.col("source").alias("item"))), ["lang", "o"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    term = rows.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("p") - _p(F.col("lang_n"), F.col("lang_total"), F.col("v"), smooth, scale)).alias("value"),
    ).filter("value > 0")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pair.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
