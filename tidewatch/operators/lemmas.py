"""X6, lemma half: tokens and keywords compared by their lemma.

A lemma comes from a table of forms; a form outside it is cut by the first
suffix rule of its language that fits, and what is left is looked up again
(a regular ending on an irregular word). Words that neither knows are their own
lemma. Everything is worked out per distinct (language, word), by two equi-joins
with the table and native string functions; the table is broadcast only when its
size estimate allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.common import checked_broadcast, small_side

# (language, suffix, replacement, least letters that stay): tried in order, the first that fits is applied.
SUFFIX_RULES = [
    ("en", "ies", "y", 2), ("en", "sses", "ss", 2), ("en", "ing", "", 3), ("en", "ed", "", 3), ("en", "s", "", 3),
    ("de", "en", "", 3), ("de", "er", "", 3), ("de", "n", "", 3),
    ("fr", "aux", "al", 2), ("fr", "es", "", 3), ("fr", "s", "", 3), ("es", "es", "", 3), ("es", "s", "", 3),
]


def cut_suffix(lang, word, rules=SUFFIX_RULES) -> Column:
    """The word by the first rule of its language that fits, else the word."""
    la = F.col(lang) if isinstance(lang, str) else lang
    w = F.col(word) if isinstance(word, str) else word
    out = w
    for code, suffix, instead, least in reversed(rules):
        fits = (la == code) & w.endswith(suffix) & (F.length(w) >= len(suffix) + least)
        out = F.when(fits, F.concat(w.substr(F.lit(1), F.length(w) - len(suffix)), F.lit(instead))).otherwise(out)
    return out


def with_lemma(words: DataFrame, lemmas: DataFrame, word_col: str = "term", rules=SUFFIX_RULES) -> DataFrame:
    """``words`` (lang, word, ...) with a column ``lemma``: the table's lemma of the
    word, else the table's lemma of the cut word, else the cut word. ``lemmas`` is
    (lang, form, lemma); a form listed twice takes its least lemma."""
    known = lemmas.groupBy("lang", F.lower("form").alias("form")).agg(F.min(F.lower("lemma")).alias("lemma"))
    whole = checked_broadcast(known.select(F.col("lang").alias("_l1"), F.col("form").alias("_f1"), F.col("lemma").alias("_whole")))
    cut = checked_broadcast(known.select(F.col("lang").alias("_l2"), F.col("form").alias("_f2"), F.col("lemma").alias("_part")))
    w = words.withColumn("_cut", cut_suffix("lang", word_col, rules))
    w = w.join(whole, (F.col("lang") == F.col("_l1")) & (F.col(word_col) == F.col("_f1")), "left")
    w = w.join(cut, (F.col("lang") == F.col("_l2")) & (F.col("_cut") == F.col("_f2")), "left")
    return w.select(*[F.col(f"`{c}`") for c in words.columns], F.coalesce("_whole", "_part", "_cut").alias("lemma"))


def lemma_pairs(msgs: DataFrame, keywords: DataFrame, lemmas: DataFrame, rules=SUFFIX_RULES) -> DataFrame:
    """(row, term, keyword, lemma) for every distinct token whose lemma is that of
    a one-word keyword of the message's language. Phrases are J1's.

    ``msgs`` needs ``_row``, ``Language`` and ordered tokens ``tok``. The keyword
    side is joined to the distinct words; the words found are materialised,
    measured and joined back like J1's.
    """
    single = keywords.filter(~F.col("keyword").contains(" ")).select("lang", F.col("keyword").alias("term")).distinct()
    keys = with_lemma(single, lemmas, "term", rules).select("lang", F.col("term").alias("keyword"), "lemma")
    toks = msgs.select("_row", F.col("Language").alias("lang"), F.explode(F.array_distinct("tok")).alias("term"))
    words = with_lemma(toks.select("lang", "term").distinct(), lemmas, "term", rules)
    found = words.join(checked_broadcast(keys), ["lang", "lemma"]).select("lang", "term", "keyword", "lemma")
    return toks.join(small_side(found), ["lang", "term"]).select("_row", "term", "keyword", "lemma")
