"""P6 for a whole track list: every term of a list of any size against every text.

A literal filter tests one ``contains`` per term and row, so its cost grows with
the list. Here the terms are put into one automaton per task, and a text is read
once, whatever the number of terms. A list goes to the tasks in blocks of at most
``MAX_BYTES`` (measured before anything is collected); beyond one block the
texts are read once per block and the blocks' results are put together, so no
term is left out.

Defined results: texts and terms are compared lower-cased; a term is found
anywhere in a text, also inside a word; terms are distinct, null and blank ones
match nothing; a null text holds no term; rows of equal keys come out alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of terms (and their overhead) in one block.
MAX_BYTES = 16 << 20
_TERM_OVERHEAD = 64


def _distinct_terms(terms: DataFrame, term_col: str) -> DataFrame:
    t = F.lower(F.col(term_col))
    return terms.select(t.alias("term")).filter(F.col("term").isNotNull() & (F.trim("term") != "")).distinct()


def _blocks(terms: DataFrame, term_col: str, max_bytes: int) -> Iterator[Broadcast]:
    """The distinct terms in blocks of bounded size, one at a time on the driver."""
    from tidewatch.operators.common import cut_lineage

    spark = terms.sparkSession
    distinct = cut_lineage(_distinct_terms(terms, term_col))
    size = distinct.agg(F.sum(F.octet_length("term") + F.lit(_TERM_OVERHEAD)).alias("b")).first()["b"] or 0
    n = -(-int(size) // max_bytes)
    for block in range(n):
        own = distinct.filter(F.pmod(F.xxhash64("term"), F.lit(n)) == block) if n > 1 else distinct
        yield spark.sparkContext.broadcast([r["term"] for r in own.toLocalIterator()])


def _automaton(block: Broadcast) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in block.value:
        found.add_word(term, term)
    if len(found):
        found.make_automaton()
    return found


def _held(texts: pa.Array, automaton: ahocorasick.Automaton) -> Iterator[set[str]]:
    """The terms in each text (texts are taken one by one, never the whole batch as Python strings)."""
    for text in texts:
        t = text.as_py()
        yield {term for _, term in automaton.iter(t)} if t and len(automaton) else set()


def track_pairs(msgs: DataFrame, terms: DataFrame, term_col: str = "term", text_col: str = "Sentence",
                key_col: str = "_row", max_bytes: int = MAX_BYTES) -> DataFrame:
    """(key, term) for every distinct term that a text holds. No shuffle."""
    read = msgs.select(F.col(key_col).alias("key"), F.lower(F.col(text_col).cast("string")).alias("text"))
    key_type = read.schema["key"].dataType.simpleString()

    def pairs_of(block: Broadcast) -> DataFrame:
        def run(batches):
            automaton = _automaton(block)
            for batch in batches:
                at, held = [], []
                for i, found in enumerate(_held(batch.column(1), automaton)):
                    at += [i] * len(found)
                    held += found
                keys = batch.column(0).take(pa.array(at, pa.int64()))
                yield pa.record_batch([keys, pa.array(held, pa.string())], ["key", "term"])

        return read.mapInArrow(run, f"key {key_type}, term string")

    out = None
    for block in _blocks(terms, term_col, max_bytes):
        found = pairs_of(block)
        out = found if out is None else out.unionByName(found)
    if out is None:  # no terms
        out = read.filter(F.lit(False)).select("key", F.col("text").alias("term"))
    return out.select(F.col("key").alias(key_col), "term")


def track_messages(msgs: DataFrame, terms: DataFrame, term_col: str = "term", text_col: str = "Sentence",
                   max_bytes: int = MAX_BYTES) -> DataFrame:
    """Messages that hold at least one term, unchanged and in place. With several
    blocks a row kept by one block is marked and passed on, so none comes twice."""
    kept = "_tracked"
    work = msgs.withColumn(kept, F.lit(False)).withColumn("_lower", F.lower(F.col(text_col).cast("string")))
    none = True

    def marked(df: DataFrame, block: Broadcast) -> DataFrame:
        def run(batches):
            automaton = _automaton(block)
            for batch in batches:
                place = batch.schema.get_field_index(kept)
                texts, before = batch.column(batch.schema.get_field_index("_lower")), batch.column(place).to_pylist()
                now = [was or (len(automaton) > 0 and bool(t.is_valid) and next(automaton.iter(t.as_py()), None) is not None)
                       for was, t in zip(before, texts, strict=True)]
                yield batch.set_column(place, batch.schema.field(place), pa.array(now, pa.bool_()))

        return df.mapInArrow(run, df.schema)

    for block in _blocks(terms, term_col, max_bytes):
        work, none = marked(work, block), False
    if none:
        return msgs.filter(F.lit(False))
    return work.filter(kept).select(*[F.col(f"`{c}`") for c in msgs.columns])
