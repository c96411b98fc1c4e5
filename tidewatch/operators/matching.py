"""Term ↔ dictionary matching: exact equi-join plus an equi-join that is the fuzzy rule.

Message terms are matched against the dictionary by an equi-join that is exactly
the F6 rule (see ``fuzzy.blocks``), and the resulting term→key map, one row per
*distinct* pair, is joined back to the messages. A dictionary that is proven
small is broadcast and terms are looked up in place; with a large one they are
reduced to the distinct vocabulary before the join.

F6 also asks for a Jaro-Winkler similarity above 0.5, which every pair that
passes the substring rule has, so no Python runs here by default. Let M be the
longer length (M >= 5) and L >= 0.8 M the common substring's. Its offset in
either term is at most 0.2 M, inside Jaro's window (M / 2 - 1 for M >= 5,
rounded), so at least L characters match: Jaro is at least (0.8 + 0.8 + 0.5) / 3
= 0.7 even if half of the matches were transposed, and Winkler only adds.
``use_jw=True`` evaluates it all the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import fuzzy as fz
from tidewatch.operators.common import checked_broadcast, proven_small


def fuzzy_pairs(terms: DataFrame, keys: DataFrame, use_jw: bool = False, by_words: bool = False) -> DataFrame:
    """Fuzzy pairs (lang, term, key) with term != key.

    ``terms``: (lang, term), ``keys``: (lang, key). Both sides are exploded to
    (longer length M of the pair, substring of ceil(0.8 M) characters); a pair
    passes F6 exactly when it meets on such a row and its longer length is M,
    so the join needs no further check and short frequent grams never meet.
    Where the size estimate of the key rows allows, they are broadcast and
    ``terms`` may hold duplicates: each task looks its terms up in place and only
    pairs found are made distinct. Else the terms are made distinct first and
    joined by shuffle.
    """
    n = ["n"] if by_words else []
    key_rows = keys.select("lang", *n, "key", F.inline(fz.blocks("key")))
    if not proven_small(key_rows):
        terms = terms.distinct()
    term_rows = terms.select("lang", *n, "term", F.inline(fz.blocks("term")))
    cand = (
        term_rows.join(checked_broadcast(key_rows), ["lang", *n, "longer", "part"])
        .filter((F.col("term") != F.col("key")) & (F.greatest(F.length("term"), F.length("key")) == F.col("longer")))
        .select("lang", *n, "term", "key")
        .distinct()
    )
    if use_jw:
        cand = cand.filter(fz.jaro_winkler("key", "term") > F.lit(fz.JW_MIN_SIMILARITY))
    return cand


def match_terms(terms: DataFrame, keys: DataFrame, fuzzy: bool = True, use_jw: bool = False,
                by_words: bool = False) -> DataFrame:
    """(lang, term) × dictionary (lang, key) → (lang, term, key, exact).

    ``terms`` may hold duplicates. Against a dictionary that is proven small they
    are looked up where they are and only hits are made distinct, so what is
    shuffled grows with the hits, not with the corpus; against a large one they
    are reduced to the distinct vocabulary first. With ``by_words`` both sides carry a word count ``n`` and only equal
    counts are compared (an n-word keyword against n-word candidates).
    """
    n = ["n"] if by_words else []
    vocab = terms.select("lang", *n, "term")
    k = keys.select("lang", *n, "key").distinct()
    if not proven_small(k):
        vocab = vocab.distinct()
    exact = vocab.join(
        checked_broadcast(k.withColumnRenamed("key", "term").withColumn("key", F.col("term"))),
        ["lang", *n, "term"],
    ).select("lang", *n, "term", "key").distinct().withColumn("exact", F.lit(True))
    if not fuzzy:
        return exact
    fz_pairs = fuzzy_pairs(vocab, k, use_jw, by_words).select("lang", *n, "term", "key", F.lit(False).alias("exact"))
    return exact.unionByName(fz_pairs)
