"""Near duplicates by word shingles: MinHash with an LSH forest, links confirmed on full sets.

A document's set holds its distinct 5-word shingles as 64-bit hashes. Equal
sets form one class at once (any number of copies costs one row each).

Method: LSH forest. Every class has one signature per tree; each tree is the
list of all signatures in sorted order (a range-partitioned sort, so a region
of any size spreads over tasks). Neighbours with a common prefix of at least
``DEPTH`` values are candidates.

1. Neighbours in the first trees are confirmed; they link most of what belongs
   together, and links contract to components.
2. In every tree, regions (signatures sharing ``DEPTH`` values) that still hold
   several components are looked into: all pairs of different components where
   the region has at most ``FULL`` classes. The depth adapts where it has more:
   the region is split by its next value, and again.
   In regions of more than ``FULL`` classes, the ``REACH`` next neighbours in the
   order of every tree are confirmed too.
3. Classes of such regions that still hold several components go through an
   exact prefix filter: a linked pair shares one of the rarest quarter of its
   shingles, and the first that it shares stands early enough in both orders to
   leave room for the common part. Pairs of different components with such a
   shingle are confirmed; none is dropped for the size of its region.

Every link is confirmed on the two full sets: 100 * common >= 75 * union.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; a row with a null id is linked with nothing
(component null, kept); rows repeating an id are classed by their own text; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import flat_bytes, mix, row_slices, word_hashes, words
from .components import components
from .tables import stored

SHINGLE = 5
TREES = 16
DEPTH = 2  # values that candidates share at least
LEVELS = 4  # values of a signature
FULL = 32
FIRST = 3  # trees of the first step
REACH = 4  # neighbours each way in regions that are too large for all pairs
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row (fewer than ``k`` words: all of them as one)."""
    rows = len(offsets) - 1
    out: list[np.ndarray] = []
    none = np.zeros(0, np.uint64)
    for a, b in row_slices(offsets, 1 << 20):
        start, end, row = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        h = word_hashes(data[offsets[a] : offsets[b]], start, end)
        n = len(h)
        if not n:
            out += [none] * (b - a)
            continue
        total, held, factor = h.copy(), np.ones(n, np.int64), np.ones(1, np.uint64)
        for j in range(1, min(k, n)):
            factor = factor * _STEP
            same = row[j:] == row[:-j]
            total[:-j] += np.where(same, h[j:] * factor, np.uint64(0))
            held[:-j] += same
        first = np.r_[True, row[1:] != row[:-1]]
        use = (held == k) | (first & (held < k))
        value, of = mix(total[use] + held[use].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), row[use]
        cuts = np.searchsorted(of, np.arange(b - a + 1))
        out += [np.unique(value[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
    assert len(out) == rows
    return out


def set_key(values: np.ndarray) -> int:
    """One 64-bit key of a set; equal sets have equal keys."""
    m = mix(values + np.uint64(0x632BE59BD9B4E019))
    key = mix(np.array([m.sum(dtype=np.uint64) ^ mix(np.bitwise_xor.reduce(mix(m))[None])[0]], np.uint64) + np.uint64(len(m)))
    return int(key.view(np.int64)[0])


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(17)
    a = rng.integers(0, 1 << 63, TREES * LEVELS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, TREES * LEVELS, dtype=np.uint64)


def signature(values: np.ndarray, coefficients) -> np.ndarray:
    """The least value of the set under each hash function, as 32 bits."""
    a, b = coefficients
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 512):
        np.minimum(low, (values[at : at + 512, None] * a + b).min(0), out=low)
    return (mix(low) >> np.uint64(32)).astype(np.uint32)


def _classed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, sig, sketch) of every document; the sketch has a byte of each value."""

    def run(batches):
        c = _coefficients()
        for batch in batches:
            sets = shingle_sets(*flat_bytes(batch.column("text")))
            signed = [signature(s, c) for s in sets]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else 0 for s in sets], pa.int64()),
                    pa.array([x.tobytes() for x in signed], pa.binary()),
                    pa.array([(x & 255).astype(np.uint8).tobytes() for x in signed], pa.binary()),
                ],
                ["doc_id", "n_shingles", "node", "sig", "sketch"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node long, sig binary, sketch binary")


def _forest(classes: DataFrame) -> DataFrame:
    """(tree, p, q, node, n): a signature's first two values are p, its others q."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(n, TREES, LEVELS).astype(np.uint64)
            p, q = ((sig[:, :, i] << np.uint64(32)) | sig[:, :, i + 1] for i in (0, 2))
            yield pa.record_batch(
                [
                    pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)),
                    pa.array(p.reshape(-1).view(np.int64)),
                    pa.array(q.reshape(-1).view(np.int64)),
                    pa.array(np.repeat(batch.column("node").to_numpy(), TREES)),
                    pa.array(np.repeat(batch.column("n").to_numpy(), TREES)),
                ],
                ["tree", "p", "q", "node", "n"],
            )

    return classes.select("node", "n", "sig").mapInArrow(run, "tree int, p long, q long, node long, n long")


def _similar_size(a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * 75


_SORTED = "tree int, p long, q long, node long, n long, b long, n_b long, edge boolean"


def _crowded(forest: DataFrame) -> DataFrame:
    """Rows of the forest in regions of several classes, each with its neighbour (b, n_b).

    One range-partitioned sort of all trees; what stands alone in its region is
    left out on the spot. The first and last row of a partition (``edge``) stay,
    as their region may go on in another partition.
    """
    order = ["tree", "p", "q", "node"]
    parts = int(forest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = forest.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches):
        held, out = None, 0  # the last rows so far, and how many of them are out already
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy() for i in range(5)]
            if held is not None:
                rows = [np.r_[x, y] for x, y in zip(held, rows, strict=True)]
            size = len(rows[0])
            # the last row waits for its neighbour; the one before it tells whether it has company
            yield _linked(rows, range(out, size - 1), first, False)
            first &= size == 1
            held, out = [x[-2:] for x in rows], min(1, size - 1)
        if held is not None:
            yield _linked(held, range(out, out + 1), first, True)

    return placed.mapInArrow(run, _SORTED)


def _linked(rows, wanted: range, first: bool, end: bool):
    """Of the wanted rows, those with company in their region; the first and last of a partition too."""
    t, p, q, node, n = rows
    near = (t[1:] == t[:-1]) & (p[1:] == p[:-1])
    size = len(t)
    before, after = np.r_[False, near], np.r_[near, False]
    edge = np.zeros(size, bool)
    edge[0] |= first
    edge[-1] |= end
    chosen = np.arange(size)[wanted.start : wanted.stop]
    chosen = chosen[(before | after | edge)[chosen]]
    has = after[chosen]
    nxt = np.minimum(chosen + 1, size - 1)
    kinds = [pa.int32()] + [pa.int64()] * 6 + [pa.bool_()]
    columns = [t[chosen], p[chosen], q[chosen], node[chosen], n[chosen]]
    arrays = [pa.array(x, k) for x, k in zip(columns, kinds, strict=False)]
    arrays += [pa.array(node[nxt], pa.int64(), mask=~has), pa.array(n[nxt], pa.int64(), mask=~has), pa.array(edge[chosen])]
    return pa.record_batch(arrays, [f.split()[0] for f in _SORTED.split(", ")])


def _neighbours(crowded: DataFrame, trees: int) -> DataFrame:
    """Pairs of neighbours in the sorted order of the first trees that share the first values."""
    inner = crowded.filter("b is not null").select("tree", F.col("node").alias("a"), "b", F.col("n").alias("n_a"), "n_b")
    # First and last rows of the partitions, in order: two rows each, whatever the input.
    in_order = Window.orderBy("tree", "p", "q", "node")
    ends = crowded.filter("edge").withColumns({x + "2": F.lead(x).over(in_order) for x in ("tree", "p", "node", "n")})
    across = ends.filter("tree = tree2 and p = p2 and node <> node2").select(
        "tree", F.col("node").alias("a"), F.col("node2").alias("b"), F.col("n").alias("n_a"), F.col("n2").alias("n_b")
    )
    return (
        inner.unionByName(across).filter((F.col("tree") < trees) & _similar_size("n_a", "n_b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


_FILTER_BITS = 1 << 24


def _place(id_col: str):
    """Word and bit of an id in a bitmap of _FILTER_BITS bits."""
    at = F.pmod(F.xxhash64(id_col), F.lit(_FILTER_BITS))
    return F.shiftright(at, 6).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("_bit")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (rep, ...) with the text of document ``rep``.

    A bitmap of the wanted ids, of a fixed size (at most _FILTER_BITS / 64 rows
    of two numbers, so it is broadcast), keeps other documents' texts out of
    the shuffle; the join afterwards is exact.
    """
    bitmap = wanted.select(*_place("rep")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    likely = (
        docs.select("*", *_place("doc_id")).join(F.broadcast(bitmap), "_word")
        .filter(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select("doc_id", "text")
    )
    return likely.join(wanted, F.col("doc_id") == F.col("rep")).drop("doc_id", "rep")


def _alike(batches):
    """Leaves out pairs whose signatures agree in less than half of their values: at a
    similarity of 0.75 that has probability 4e-6, and their texts need not travel."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sketch_a", "sketch_b"))
        yield batch.select(["a", "b"]).filter(pa.array(2 * (a == b).sum(1) >= TREES * LEVELS))


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, alike: bool = False) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity; unlike signatures (unless the
    pairs are ``alike`` already) are not looked into."""
    if not alike:
        sketch = classes.select("node", "sketch")
        pairs = (
            pairs.join(sketch.toDF("a", "sketch_a"), "a").join(sketch.toDF("b", "sketch_b"), "b")
            .mapInArrow(_alike, "a long, b long")
        )
    pairs = stored(pairs)
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _texts_of(docs, ends.join(classes.select("node", "rep"), "node"))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x, y = (shingle_sets(*flat_bytes(part.column(c))) for c in ("text_a", "text_b"))
                ids = part.column("a").to_pylist(), part.column("b").to_pylist()
                good = []
                for s, t, i, j in zip(x, y, *ids, strict=True):
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    good.append(
                        100 * common >= 75 * (len(s) + len(t) - common) and set_key(s) == i and set_key(t) == j
                    )
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long").distinct()


def _next_in_order(rows: DataFrame, reach: int) -> DataFrame:
    """Pairs of different components with like signatures among the next ``reach`` rows in the
    sorted order of a region."""
    order = ["tree", "p", "q", "node"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy() for i in range(6)]
            cols.append(np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint8).reshape(batch.num_rows, -1))
            if held is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(held, cols, strict=True)]
            t, p, _, node, n, root, sketch = cols
            old = 0 if held is None else len(held[0])
            for d in range(1, reach + 1):
                k = np.arange(max(0, old - d), len(t) - d)
                k = k[(t[k] == t[k + d]) & (p[k] == p[k + d]) & (root[k] != root[k + d])]
                k = k[np.minimum(n[k], n[k + d]) * 100 >= np.maximum(n[k], n[k + d]) * 75]
                k = k[2 * (sketch[k] == sketch[k + d]).sum(1) >= TREES * LEVELS]
                low, high = np.minimum(node[k], node[k + d]), np.maximum(node[k], node[k + d])
                yield pa.record_batch([pa.array(low), pa.array(high)], ["a", "b"])
            held = [x[-reach:] for x in cols]

    placed = rows.select(*order, "n", "root", "sketch").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return placed.mapInArrow(run, "a long, b long").distinct()


def _with_roots(forest: DataFrame, links: DataFrame) -> DataFrame:
    """The forest's rows with the component of their class."""
    roots = components(links)
    return forest.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open_regions(rooted: DataFrame, keys: list[str]) -> DataFrame:
    """Regions that hold several components, with their number of classes."""
    return (
        rooted.groupBy(*keys).agg(F.count("*").alias("m"), F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high").select(*keys, "m")
    )


def _pairs_within(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of different components within regions of at most FULL classes."""
    other = rows.select(*keys, F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"))
    mine = rows.select(*keys, F.col("node").alias("a"), "root", "n")
    return (
        mine.join(other, keys).filter((F.col("a") < F.col("b")) & (F.col("root") != F.col("root_b")) & _similar_size("n", "n_b"))
        .select("a", "b").distinct()
    )


def _rare_pairs(rest: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Exact way for classes (node, root) of the largest regions: pairs of different
    components that share one of the rarest quarter of their shingles."""
    texts = _texts_of(docs, rest.join(classes.select("node", "rep", "n"), "node"))

    def run(batches):
        for batch in batches:
            # An id may stand on several texts: only the class's own counts.
            nodes = batch.column("node").to_pylist()
            sets = shingle_sets(*flat_bytes(batch.column("text")))
            sets = [s if len(s) and set_key(s) == node else s[:0] for s, node in zip(sets, nodes, strict=True)]
            size = [len(s) for s in sets]
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            at = np.repeat(np.arange(len(sets)), size)
            yield pa.record_batch(
                [*(pa.array(batch.column(c).to_numpy()[at]) for c in ("node", "root", "n")), pa.array(flat)],
                ["node", "root", "n", "s"],
            )

    rows = texts.select("node", "root", "n", "text").mapInArrow(run, "node long, root long, n long, s long")
    rows = stored(rows.distinct())  # a text of a class may stand in several rows
    # A shingle within one component only links nothing new, but counts in the order.
    counted = rows.groupBy("s").agg(F.count("*").alias("c"), F.min("root").alias("low"), F.max("root").alias("high"))
    w = Window.partitionBy("node").orderBy("c", "s")
    prefix = (
        rows.join(counted, "s").withColumn("k", F.row_number().over(w))
        .filter((F.col("k") <= F.col("n") - F.ceil(F.col("n") * 0.75) + 1) & (F.col("low") != F.col("high")))
    )
    prefix = stored(prefix.select("s", "node", "root", "n", "k"))
    # Of each pair one class is outside the shingle's commonest component.
    common = (
        prefix.groupBy("s", "root").count().groupBy("s").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    )
    mine = prefix.join(common, "s").filter(F.col("root") != F.col("main")).select("s", F.col("node").alias("a"), "root", "n", "k")
    other = prefix.select("s", F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("root", "n", "k")])
    # All that two sets share stands at or after their first common shingle, in both.
    least = F.ceil((F.col("n") + F.col("n_b")) * 75 / 175)
    room = (F.col("n") - F.col("k") + 1 >= least) & (F.col("n_b") - F.col("k_b") + 1 >= least)
    return (
        mine.join(other, "s").filter((F.col("root") != F.col("root_b")) & _similar_size("n", "n_b") & room)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) of every document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = stored(_classed(docs))
    linked = base.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = stored(
        linked.groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    )
    signed = linked.groupBy("node").agg(F.max("n_shingles").alias("n"), F.first("sig").alias("sig"))
    crowded = stored(_crowded(_forest(signed)))
    forest = crowded.select("tree", "p", "q", "node", "n")

    compared = stored(_neighbours(crowded, FIRST))  # no pair is looked at twice
    links = stored(_confirmed(compared, docs, classes))
    rooted = _with_roots(forest, links).withColumn("p2", F.shiftrightunsigned("q", 32))
    rows, pairs = rooted, []
    for keys in (["tree", "p"], ["tree", "p", "p2"], ["tree", "p", "q"]):  # regions by their first 2, 3 and 4 values
        rows = stored(rows.join(_open_regions(rows, keys), keys))
        pairs.append(_pairs_within(rows.filter(F.col("m") <= FULL), keys))
        rows = rows.filter(F.col("m") > FULL).drop("m")
        if rows.isEmpty():
            break
    looked_into = stored(reduce(DataFrame.unionByName, pairs).distinct().join(compared, ["a", "b"], "left_anti"))
    compared = compared.unionByName(looked_into)
    links = stored(links.unionByName(_confirmed(looked_into, docs, classes)))

    # In larger regions neighbours of all trees link most of what belongs together ...
    rooted, big = _with_roots(forest, links), ["tree", "p"]
    large = stored(rooted.join(_open_regions(rooted, big).filter(F.col("m") > FULL).drop("m"), big))
    if not large.isEmpty():
        sketched = large.join(classes.select("node", "sketch"), "node")
        following = stored(_next_in_order(sketched, REACH).join(compared, ["a", "b"], "left_anti"))
        compared = compared.unionByName(following)
        links = stored(links.unionByName(_confirmed(following, docs, classes, alike=True)))
    # ... and what never came into a small region goes the exact way.
    rooted = _with_roots(large.drop("root"), links)
    rest = stored(rooted.join(_open_regions(rooted, big).drop("m"), big).select("node", "root").distinct())
    if not rest.isEmpty():
        rare = _rare_pairs(rest, docs, classes).join(compared, ["a", "b"], "left_anti")
        links = stored(links.unionByName(_confirmed(rare, docs, classes)))

    roots = classes.select("node", "rep").join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = roots.groupBy("root").agg(F.min("rep").alias("component_id"))
    component = roots.join(least, "root").select("node", "component_id")
    return (
        base.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
        .join(component, "node", "left")
        .withColumn(
            "component_id",
            F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")),
        )
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )
