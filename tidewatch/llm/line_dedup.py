"""Line dedup by winnowing over line hashes; DataFrame functions only.

Rule. The lines of a text are its parts between line feeds; blank lines (white
space only) take no part. A line goes if

* it lies in ``min_lines`` consecutive lines that occurred before, or
* it occurred before by itself and has at least ``long_line`` characters, or at
  least ``short_line`` characters and stands in at least ``common`` documents.

Before means in an earlier document (smaller id) or earlier in the same one.
Blank lines inside a deleted run go with it. The first occurrence stays.
Repeated lines that are shorter, or rarer, stay: headings and list signs.

Method: winnowing. Every window of ``min_lines`` line hashes selects its least
one (the last of equals); the selected positions are the text's fingerprints,
and as the choice depends on the window alone, any two places that share a
repeated run share a fingerprint in it. Fingerprints that stand at one place
only are dropped. The others are extended both ways, over the lines on their
left and right that they were selected for, and each extended match is joined
to its first place. Matches that overlap or touch are one run; later runs are
deleted. Single lines are their own match and are joined to their first place
in the same way.

Skew: first places are aggregates with partial sums, and the joins are against
one row per key, so a line that stands in every document costs no pairs.

Defined results: a null text stays null and an empty one empty (no lines); a
null id is before all others; rows that repeat id and text are one document
and come out alike; rows that only repeat an id are ordered by a hash of their
text; a very long text is one row here as in the input, its lines one row each,
and work grows with its length; equal lines are ordered by document and place;
an empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

MIN_LINES = 2
LONG_LINE = 40  # characters from which a single repeated line goes
SHORT_LINE = 10  # characters from which it goes where COMMON documents have it
COMMON = 10
MAX_FILTER_BITS = 1 << 26


def _keys(id_col: str, text_col: str) -> list[Column]:
    """Id (null first) and text hash: what tells documents apart and orders them."""
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k1"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k2"),
    ]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


_PLACE = ["k1", "k2", "pos"]


def _lines(docs: DataFrame, text_col: str, min_lines: int) -> DataFrame:
    """(k1, k2, pos, i, h, n, at, around): every line that is not blank with its place among
    these and among all lines, hash and length. A fingerprint has the (i, h) of the lines up to
    ``min_lines`` - 1 places before and after it, and its own place ``at`` there."""
    numbered = F.transform(
        lines_of(F.col(text_col)),
        lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h"), F.length(x).alias("n"), (F.trim(F.translate(x, "\t\r\f\v", "    ")) == "").alias("blank")),
    )
    solid = docs.select("k1", "k2", F.filter(numbered, lambda s: ~s["blank"]).alias("s"))
    s, w = F.col("s"), min_lines
    least = lambda p: F.array_min(F.transform(F.slice(s, p + 1, w), lambda x, o: F.struct(x["h"].alias("h"), (-p - o).alias("at"))))
    chosen = F.when(F.size(s) >= w, F.transform(F.sequence(F.lit(0), F.size(s) - w), lambda p: -least(p)["at"])).otherwise(F.array().cast("array<int>"))
    placed = solid.select("k1", "k2", "s", F.array_distinct(chosen).alias("chosen"))
    every = F.transform(s, lambda x, pos: F.struct(pos.alias("pos"), x["i"].alias("i"), x["h"].alias("h"), x["n"].alias("n"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("array<struct<i:int,h:bigint>>").alias("around")))
    low = lambda pos: F.greatest(pos - (w - 1), F.lit(0))
    anchors = F.transform(
        F.col("chosen"),
        lambda pos: F.struct(
            pos.alias("pos"), F.element_at(s, pos + 1)["i"].alias("i"), F.element_at(s, pos + 1)["h"].alias("h"), F.lit(None).cast("int").alias("n"),
            (pos - low(pos)).alias("at"),
            F.transform(F.slice(s, low(pos) + 1, pos + w - low(pos)), lambda x: F.struct(x["i"].alias("i"), x["h"].alias("h"))).alias("around"),
        ),
    )
    return placed.select("k1", "k2", F.inline(F.concat(every, anchors)))


def _extended(anchors: DataFrame, min_lines: int) -> DataFrame:
    """(k1, k2, pos, len, i, j, key): the windows that each fingerprint was selected for."""
    w, around, at = min_lines, F.col("around"), F.col("at")
    starts = F.sequence(F.lit(0), F.size(around) - w)
    own = F.filter(  # the fingerprint is the last of the least hashes in the window at p
        starts,
        lambda p: (p <= at) & (at < p + w)
        & F.forall(F.transform(F.slice(around, p + 1, w), lambda x, o: (x["h"] > F.col("h")) | ((x["h"] == F.col("h")) & (p + o <= at))), lambda good: good),
    )
    window = F.transform(
        own,
        lambda p: F.struct(
            (F.col("pos") - at + p).alias("pos"), F.lit(w).alias("len"),
            F.element_at(around, p + 1)["i"].alias("i"), F.element_at(around, p + w)["i"].alias("j"),
            F.xxhash64(F.transform(F.slice(around, p + 1, w), lambda x: x["h"])).alias("key"),
        ),
    )
    return anchors.select("k1", "k2", F.inline(window))


def _later(matches: DataFrame, first: DataFrame) -> DataFrame:
    """The matches at other places than the first one of their key."""
    return matches.join(first, "key").filter(F.struct(*_PLACE) != F.col("first")).select(*_PLACE, "len", "i", "j")


def _first_places(matches: DataFrame, *more: Column) -> DataFrame:
    """(key, first) of the keys that stand at several places."""
    place = F.struct(*_PLACE)
    return matches.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last"), *more).filter("first <> last").drop("last")


def _repeated_windows(lines: DataFrame, min_lines: int) -> DataFrame:
    anchors = lines.filter("around is not null")
    shared = _first_places(anchors.withColumnRenamed("h", "key")).select(F.col("key").alias("h"))
    matches = stored(_extended(anchors.join(shared, "h", "left_semi"), min_lines))
    return _later(matches, _first_places(matches))


def _repeated_single(lines: DataFrame, long_line: int, short_line: int, common: int) -> DataFrame:
    single = lines.filter((F.col("n") >= min(long_line, short_line)) & F.col("around").isNull()).select(
        *_PLACE, F.lit(1).alias("len"), "i", F.col("i").alias("j"), F.col("h").alias("key"), "n"
    )
    first = stored(_first_places(single, F.max("n").alias("n")))
    short = first.filter(F.col("n") < long_line)
    spread = (
        single.join(short.select("key"), "key", "left_semi").select("key", "k1", "k2").distinct()
        .groupBy("key").count().filter(F.col("count") >= common).select("key")
    )
    going = first.filter(F.col("n") >= long_line).unionByName(short.join(spread, "key", "left_semi"))
    return _later(single.drop("n"), going.drop("n"))


def repeated_runs(
    docs: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE, short_line: int = SHORT_LINE, common: int = COMMON, text_col: str = "text"
) -> DataFrame:
    """(k1, k2, cut): sorted runs (first line, last line) to delete from each document that has any."""
    lines = stored(_lines(docs, text_col, min_lines))
    later = _repeated_windows(lines, min_lines).unionByName(_repeated_single(lines, long_line, short_line, common)).distinct()
    # Matches that overlap or touch form one run of lines.
    by_doc = Window.partitionBy("k1", "k2").orderBy("pos", "len")
    reach = F.max(F.col("pos") + F.col("len")).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        later.withColumn("new", F.when(F.col("pos") <= reach, 0).otherwise(1))
        .withColumn("run", F.sum("new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("k1", "k2", "run").agg(F.min("i").alias("i"), F.max("j").alias("j"))
    )
    # At most one entry per line of the document.
    return runs.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("i", "j"))).alias("cut"))


def _without(lines: Column, cut: Column) -> Column:
    """Text of the lines outside the runs of ``cut``."""
    starts = F.concat(F.array(F.lit(0)), F.transform(cut, lambda r: r["j"] + 1))
    ends = F.concat(F.transform(cut, lambda r: r["i"]), F.array(F.size(lines)))
    pieces = F.filter(
        F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), (b - a).alias("n"))), lambda p: p["n"] > 0
    )
    return F.array_join(F.transform(pieces, lambda p: F.array_join(F.slice(lines, p["a"] + 1, p["n"]), "\n")), "\n")


def _split_by(keyed: DataFrame, cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``keyed`` that may have a cut, and those that have none.

    A bitmap of the cut documents' keys (16 bits a document, at most
    MAX_FILTER_BITS / 64 rows of two numbers, so it is broadcast) tells them
    apart; texts without a cut need no shuffle. The join afterwards is exact.
    """
    bits = min(MAX_FILTER_BITS, max(1 << 16, 1 << (16 * cuts.count()).bit_length()))
    at = F.pmod(F.xxhash64("k1", "k2"), F.lit(bits))
    place = [F.shiftright(at, 6).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("_bit")]
    bitmap = cuts.select(*place).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    told = keyed.select("*", *place).join(F.broadcast(bitmap), "_word", "left")
    likely = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))
    return told.filter(likely).select(*keyed.columns), told.filter(~likely).select(*keyed.columns)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, long_line: int = LONG_LINE,
    short_line: int = SHORT_LINE, common: int = COMMON,
) -> DataFrame:
    """``docs`` with repeated runs deleted from the texts, and struct ``_lines`` (n, removed)."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(own, F.col(text_col).cast("string").alias("text"), *_keys(id_col, text_col))
    cuts = stored(repeated_runs(keyed, min_lines, long_line, short_line, common))
    lines = lines_of(F.col("text"))
    maybe, whole = _split_by(keyed, cuts)
    joined = maybe.join(cuts, ["k1", "k2"], "left").unionByName(whole, allowMissingColumns=True)
    kept = F.when(F.col("cut").isNull(), F.col("text")).otherwise(_without(lines, F.col("cut")))
    removed = F.aggregate(
        F.coalesce(F.col("cut"), F.array().cast("array<struct<i:int,j:int>>")), F.lit(0).cast("long"), lambda n, r: n + r["j"] - r["i"] + 1
    )
    count = F.when(F.coalesce(F.col("text"), F.lit("")) == "", 0).otherwise(F.size(lines)).cast("long")
    columns = [kept.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return joined.select(*columns, F.struct(count.alias("n"), removed.alias("removed")).alias("_lines"))
