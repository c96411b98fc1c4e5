"""Document fingerprints by SimHash, and search by Hamming radius; DataFrame functions only.

A text's terms are its pairs of neighbouring words (a word alone, if it has
one). Every occurrence of a term votes on 64 bits with the term's hash, so a
term weighs as often as it occurs; a bit is set if more than half of the votes
have it. The counters of two bits share one long (32 bits each), so a text's
votes are 32 sums, combined within each task before anything is shuffled.

Fingerprints within radius r agree on ``blocks - r`` of ``blocks`` blocks of
bits. ``within_radius`` keeps one table per such choice, with the bits of the
chosen blocks as key, so every fingerprint within the radius is found; equal
fingerprints are one row with a count.

Defined results: a null text is the empty text; a text without words has
fingerprint 0; a null id is below all others in the order of documents; rows
that repeat id and text are one document in that order and come out alike; rows
that only repeat an id are ordered by a hash of their text; a single document
is its own next one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.common import cut_lineage

BITS = 64
RADIUS = 3
BLOCKS = 5
_LOW_EACH = 0x0000000100000001  # lowest bit of both halves


def _terms(text: Column) -> Column:
    """Neighbouring words as structs (w0, w1)."""
    blank = F.replace(F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" ")), F.lit("\r"), F.lit(" "))
    words = F.array_remove(F.split(blank, " "), "")
    return F.when(F.size(words) > 1, F.arrays_zip(F.slice(words, 1, F.size(words) - 1).alias("w0"), F.slice(words, 2, F.size(words) - 1).alias("w1"))).otherwise(
        F.arrays_zip(words.alias("w0"), words.alias("w1"))
    )


def _vote_sums() -> list[Column]:
    """32 sums; sum j counts bit j in its low half and bit j + 32 in its high half."""
    return [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_LOW_EACH))).alias(f"v{j}") for j in range(BITS // 2)]


def _bits() -> Column:
    """The fingerprint of the vote sums: a bit is set by more than half of the votes."""
    out = F.lit(0).cast("long")
    for b in range(BITS):
        sums = F.col(f"v{b % 32}")
        votes = sums.bitwiseAND(F.lit(0xFFFFFFFF)) if b < 32 else F.shiftrightunsigned(sums, 32)
        bit = -(1 << 63) if b == 63 else 1 << b
        out = out.bitwiseOR(F.when(votes * 2 > F.col("votes"), F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` and ``fp`` (long) for each key of ``texts``; without words it is 0."""
    exploded = texts.select(*keys, F.inline_outer(_terms(F.col(text_col))))
    hashed = exploded.select(*keys, F.when(F.col("w0").isNotNull(), F.xxhash64("w0", "w1")).otherwise(0).alias("h"))
    sums = hashed.groupBy(*keys).agg(F.count("*").alias("votes"), *_vote_sums())
    return sums.select(*keys, _bits().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _masks(radius: int, blocks: int) -> list[int]:
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = [sum(parts[i] for i in c) for c in combinations(range(blocks), blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within_radius(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(q, fp) for every distinct fingerprint of ``corpus`` within ``radius`` bits of one of ``queries`` (column fp)."""
    masks = _masks(radius, blocks)

    def tables(df: DataFrame, name: str) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for i, m in enumerate(masks)])
        return df.select("fp").distinct().select(F.col("fp").alias(name), F.inline(rows))

    near = tables(queries, "q").join(tables(corpus, "fp"), ["t", "key"])
    return near.filter(F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius).select("q", "fp").distinct()


def _neighbours(light: DataFrame) -> DataFrame:
    """(k1, k2, c, n, next_k1, next_k2, prev_k1, prev_k2, prev_n): documents in descending order, closed to a ring.

    Sorted by ranges; only the ends of the ranges (one row per partition) meet in one place.
    """
    order = [F.desc("k1"), F.desc("k2")]
    parts = int(light.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(light.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    mine = F.struct("k1", "k2", "n")
    ends = placed.groupBy("part").agg(F.max(mine).alias("first"), F.min(mine).alias("last"))
    w = Window.orderBy("part")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lead("first").over(w), F.first("first").over(whole)).alias("after"),
        F.coalesce(F.lag("last").over(w), F.last("last").over(whole)).alias("before"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    ring = (
        placed.withColumn("down", F.lead(mine).over(inside)).withColumn("up", F.lag(mine).over(inside))
        .join(F.broadcast(ends), "part")  # one row per shuffle partition
        .withColumn("down", F.coalesce("down", "after")).withColumn("up", F.coalesce("up", "before"))
    )
    return ring.select(
        "k1", "k2", "c", "n", F.col("down.k1").alias("next_k1"), F.col("down.k2").alias("next_k2"),
        F.col("up.k1").alias("prev_k1"), F.col("up.k2").alias("prev_k2"), F.col("up.n").alias("prev_n"),
    )


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_step: int = 50) -> DataFrame:
    """Fingerprints of every text and of its edited text, their likeness, and that to the next document.

    The edited text has its last floor(n / 3) code points replaced by the first
    as many of the next document (descending id; after the last, the first).
    ``n_within`` counts the other rows within RADIUS bits, for the rows whose id
    is divisible by ``query_step`` (the query set); null for the others.
    """
    least = -(1 << 63)
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("k1"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("k2", F.xxhash64("text"))
    light = keyed.groupBy("k1", "k2", F.length("text").cast("long").alias("n")).agg(F.count("*").alias("c"))
    ring = cut_lineage(_neighbours(light))

    full = keyed.join(ring.select("k1", "k2", "n", "prev_k1", "prev_k2", "prev_n"), ["k1", "k2"])
    heads = full.select(
        F.col("prev_k1").alias("k1"), F.col("prev_k2").alias("k2"), F.substring("text", F.lit(1), (F.col("prev_n") / 3).cast("int")).alias("head")
    )
    cut = (F.col("n") / 3).cast("int")
    both = (
        full.select("k1", "k2", "n", "text").join(heads, ["k1", "k2"])
        .select("k1", "k2", "text", F.concat(F.substring("text", F.lit(1), F.col("n").cast("int") - cut), "head").alias("edited"))
        .select("k1", "k2", F.inline(F.array(
            F.struct(F.lit("").alias("sha"), F.col("text").alias("t")), F.struct(F.sha2("edited", 256).alias("sha"), F.col("edited").alias("t"))
        )))
    )
    found = cut_lineage(fingerprints(both, ["k1", "k2", "sha"], "t"))

    own = found.filter("sha = ''").select("k1", "k2", "fp")
    edited = found.filter("sha <> ''").select("k1", "k2", F.col("fp").alias("efp"), "sha")
    after = own.select(F.col("k1").alias("next_k1"), F.col("k2").alias("next_k2"), F.col("fp").alias("nfp"))
    rows = ring.join(own, ["k1", "k2"]).join(edited, ["k1", "k2"]).join(after, ["next_k1", "next_k2"])

    counted = own.join(ring.select("k1", "k2", "c"), ["k1", "k2"]).groupBy("fp").agg(F.sum("c").alias("c"))
    asked = own.filter((F.col("k1") != least) & (F.col("k1") % query_step == 0))
    within = (
        within_radius(asked, own).join(counted, "fp").groupBy(F.col("q").alias("fp")).agg((F.sum("c") - 1).alias("n_within"))
    )
    hex_of = lambda c: F.lpad(F.lower(F.hex(c)), BITS // 4, "0")
    return (
        rows.join(within, "fp", "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("c"))))
        .select(
            F.when(F.col("k1") != least, F.col("k1")).alias("doc_id"), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"),
            hex_of("fp").alias("fingerprint"), hex_of("efp").alias("edited_fingerprint"),
            likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"),
            F.when((F.col("k1") != least) & (F.col("k1") % query_step == 0), F.col("n_within")).alias("n_within"),
        )
    )
