"""Text functions: tokens, n-grams, raw-line cleanup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: token separators when a message carries no NLP tokens.
TOKEN_SPLIT = "[ ,.]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_tokens(text) -> Column:
    """Ordered lower-cased tokens of a text; empty tokens are kept."""
    return F.split(F.lower(_c(text)), TOKEN_SPLIT, -1)


def ordered_tokens(lang, words, tokens, text) -> Column:
    """Tokens in text order: ``en`` uses NLP words, other languages NLP tokens,
    and without NLP output the text is split on space, comma and dot."""
    nlp = F.when(_c(lang) == "en", _c(words)).otherwise(_c(tokens))
    return F.transform(F.coalesce(nlp, F.split(_c(text), TOKEN_SPLIT, -1)), lambda t: F.lower(t))


def tokenize(lang, words, tokens, text) -> Column:
    """F1 + A11: distinct tokens in first-occurrence order."""
    return F.array_distinct(ordered_tokens(lang, words, tokens, text))


def ngrams(tokens, n: int) -> Column:
    """contiguous n-grams joined by a space, only where n tokens follow."""
    t = _c(tokens)
    return F.when(
        F.size(t) >= n,
        F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.array_join(F.slice(t, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def phrase_candidates(tokens, max_words: int) -> Column:
    """Distinct single tokens plus distinct 2..max_words-grams of the ordered tokens (Q1)."""
    t = _c(tokens)
    parts = [F.array_distinct(t)] + [ngrams(t, n) for n in range(2, max_words + 1)]
    return F.array_distinct(F.concat(*parts))


def prune_newlines(raw) -> Column:
    """Drop the two-character escapes backslash-n and backslash-r from raw JSON text."""
    return F.regexp_replace(_c(raw), r"\\[nr]", "")


def phrase_candidates_n(tokens, counts) -> Column:
    """Candidates with their word count: array<struct<n:int, term:string>>, for
    the word counts of a list (or 1..n of a number). A keyword of n words is
    only compared with n-word candidates. Single words are distinct; a phrase
    is there as often as it occurs (Q1)."""
    counts = range(1, counts + 1) if isinstance(counts, int) else counts
    t = _c(tokens)

    def tagged(n: int):
        return lambda x: F.struct(F.lit(n).alias("n"), x.alias("term"))

    parts = [F.transform(F.array_distinct(t) if n == 1 else ngrams(t, n), tagged(n)) for n in counts]
    return F.concat(*parts) if parts else F.array().cast("array<struct<n:int,term:string>>")
