"""Message tagging: routing, tokens, keywords, categories.

Shape of the plan for J1/J2 (per message, stateless apart from dictionaries):

    messages ─explode candidates─▶ (row, lang, term) ─┬─▶ distinct vocabulary ─▶ match map
                                                     └─▶ ⋈ match map (broadcast if checked small)
                                                           ─▶ (row, keyword) ─▶ arrays per row

The fuzzy work is bounded by the vocabulary, not by the message count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import ordered_tokens, phrase_candidates_n
from tidewatch.functions.timeutil import parse_created
from tidewatch.operators.common import checked_broadcast, cut_lineage, small_side, with_row_key
from tidewatch.operators.matching import match_terms

# Source names and their codes (P10); default is twitter.
SOURCE_CODES = {"rss": 0, "twitter": 1, "facebook-messages": 2, "facebook-comments": 3}
DEFAULT_SOURCE_CODE = 1


def route_source(envelopes: DataFrame) -> DataFrame:
    """P7 + P8: messages whose ``message.source`` has no "http" come from the
    NLP branch (source kept, text = ``message.sentence``); the others are
    tweets (source = "twitter", text = ``message.text``, language "in" → "id").

    Returns one row per envelope: MessageId, Source, Sentence, Language,
    CreatedText, geo, is_geojson (the routed source is "twitter", on either
    branch), TokenText (``message.text`` on both branches), user_id, words, tokens.
    """
    m = F.col("message")
    is_nlp = ~F.coalesce(m["source"], F.lit("")).contains("http")
    lang = F.when(is_nlp, m["lang"]).otherwise(F.when(m["lang"] == "in", F.lit("id")).otherwise(m["lang"]))
    nlp_cols = envelopes.schema["nlp"].dataType.fieldNames() if "nlp" in envelopes.columns else []
    words = F.col("nlp.words") if "words" in nlp_cols else F.lit(None).cast("array<string>")
    tokens = F.col("nlp.tokens") if "tokens" in nlp_cols else F.lit(None).cast("array<string>")
    return envelopes.select(
        m["id"].cast("string").alias("MessageId"),
        F.when(is_nlp, m["source"]).otherwise(F.lit("twitter")).alias("Source"),
        F.when(is_nlp, m["sentence"]).otherwise(m["text"]).alias("Sentence"),
        lang.alias("Language"),
        F.coalesce(m["created_at"], F.col("created_at")).alias("CreatedText"),
        m["geo"].alias("geo"),
        (F.when(is_nlp, F.coalesce(m["source"], F.lit(""))).otherwise(F.lit("twitter")) == "twitter").alias("is_geojson"),
        m["text"].alias("TokenText"),
        m["user_id"].cast("string").alias("user_id"),
        words.alias("words"),
        tokens.alias("tokens"),
    )


def with_tokens(msgs: DataFrame) -> DataFrame:
    """ordered tokens (``tok``) of each routed message, from ``TokenText``
    (``message.text``); of rows without that column, from ``Sentence``."""
    text = "TokenText" if "TokenText" in msgs.columns else "Sentence"
    return msgs.withColumn("tok", ordered_tokens("Language", "words", "tokens", text))


def normalize_source(source) -> Column:
    """P10: source name → code (case-insensitive), default twitter."""
    s = F.lower(F.col(source) if isinstance(source, str) else source)
    expr = F.lit(DEFAULT_SOURCE_CODE)
    for name, code in reversed(list(SOURCE_CODES.items())):
        expr = F.when(s == name, F.lit(code)).otherwise(expr)
    return expr


def no_signal(msgs: DataFrame) -> Column:
    """All four lists empty (logged as droppable, not dropped)."""
    return sum(
        (F.coalesce(F.size(c), F.lit(0)) for c in ("Keywords", "Sectors", "Groups", "Statuses")), F.lit(0)
    ) == 0


def has_locations(col: str = "Locations") -> Column:
    """Location list non-empty."""
    return F.coalesce(F.size(col), F.lit(0)) > 0


def emit_sentence(msgs: DataFrame) -> DataFrame:
    """Sentence rows go out only when Groups is non-empty."""
    return msgs.filter(F.coalesce(F.size("Groups"), F.lit(0)) > 0)


def _word_counts(dictionary: DataFrame, col: str) -> list[int]:
    """Word counts that dictionary entries have (one tiny aggregate on reference data)."""
    v = dictionary.select(F.array_sort(F.collect_set(F.size(F.split(col, " ")))).alias("m")).first()["m"]
    return [int(n) for n in v]


def candidates(msgs: DataFrame, counts, lang: str = "Language", tokens: str = "tok") -> DataFrame:
    """(row, lang, n, term): distinct tokens (n=1) and every n-gram, for the
    word counts asked for (a list, or the largest of 1..n). A phrase that occurs
    twice in a message gives two rows."""
    return msgs.select(
        "_row", F.col(lang).alias("lang"), F.inline(phrase_candidates_n(tokens, counts))
    )


def keyword_pairs(msgs: DataFrame, keywords: DataFrame, fuzzy: bool = True, use_jw: bool = False) -> DataFrame:
    """(row, term, keyword, exact) for every candidate that equals or
    fuzzy-equals a keyword of the message's language. Unknown language → none.

    ``msgs`` needs ``_row``, ``Language`` and ordered tokens ``tok``;
    ``keywords`` is (lang, keyword).
    """
    keys = keywords.select("lang", F.col("keyword").alias("key"), F.size(F.split("keyword", " ")).alias("n"))
    cands = candidates(msgs, _word_counts(keywords, "keyword"))
    mapping = match_terms(cands, keys, fuzzy=fuzzy, use_jw=use_jw, by_words=True)
    return cands.join(small_side(mapping), ["lang", "n", "term"]).select(
        "_row", "term", F.col("key").alias("keyword"), "exact"
    )


def category_pairs(
    msgs: DataFrame,
    categories: DataFrame,
    kind: str,
    mode: str = "any",
    phrases: bool = True,
    on_conflict: str = "last",
) -> DataFrame:
    """(row, category) for one kind (groups / sectors / statuses).

    ``mode="any"``: a category is assigned when any of its keywords is a token
    (or, with ``phrases``, an n-gram) of the message. ``mode="all"``: every
    keyword of the category must be present. ``on_conflict`` = "last" keeps the
    last category of a keyword listed twice (Q3), "all" keeps every one.
    """
    from tidewatch.sources.refdata import resolve_categories

    cat = categories.filter(F.col("kind") == kind)
    counts = _word_counts(cat, "keyword") if phrases else 1
    # The dictionary join comes first: only hits are made distinct.
    cands = candidates(msgs, counts).select("_row", "lang", "term")
    if mode == "any":
        table = resolve_categories(cat, on_conflict).select("lang", F.col("keyword").alias("term"), "category")
        return cands.join(checked_broadcast(table), ["lang", "term"]).select("_row", "category").distinct()
    # mode == "all": every listed keyword of the category line must occur
    need = cat.groupBy("lang", "category").agg(F.countDistinct("keyword").alias("need"))
    table = cat.select("lang", F.col("keyword").alias("term"), "category").distinct()
    hits = (
        cands.join(checked_broadcast(table), ["lang", "term"])
        .groupBy("_row", "lang", "category")
        .agg(F.countDistinct("term").alias("have"))
    )
    return hits.join(checked_broadcast(need), ["lang", "category"]).filter(
        F.col("have") == F.col("need")
    ).select("_row", "category")


def attach_lists(msgs: DataFrame, pairs: dict[str, DataFrame]) -> DataFrame:
    """Fold (row, value) pair tables back into sorted list columns per message.

    Each pair table is aggregated per row first (only matched rows are
    shuffled), then left-joined to the messages on the row key.
    """
    out = msgs
    for col_name, p in pairs.items():
        val = [c for c in p.columns if c != "_row"][0]
        agg = p.groupBy("_row").agg(F.array_sort(F.collect_list(val)).alias(col_name))
        out = out.join(agg, "_row", "left").withColumn(
            col_name, F.coalesce(F.col(col_name), F.array().cast("array<string>"))
        )
    return out


def tag_messages(
    envelopes: DataFrame,
    keywords: DataFrame,
    categories: DataFrame | None = None,
    kinds=("groups",),
    fuzzy: bool = True,
    use_jw: bool = False,
    mode: str = "any",
    phrases: bool = True,
    on_conflict: str = "last",
    id_col: str | None = None,
) -> DataFrame:
    """T2/E2 core: envelopes → messages with Keywords and category lists.

    Matches are joined back by a row key. ``id_col`` names a column that is
    unique and not null (``MessageId`` after de-duplication); without it the
    generated keys are stored once and every branch reads that copy, so a
    shuffled or re-evaluated input cannot give two branches different keys.

    Locations are added by ``tidewatch.operators.locate.resolve_locations``.
    Sectors and statuses are off by default, as in the reference caller.
    """
    msgs = with_tokens(with_row_key(route_source(envelopes), id_col=id_col))
    msgs = msgs.withColumn("Created", parse_created("CreatedText"))
    if id_col is None:
        msgs = cut_lineage(msgs)
    pairs = {"Keywords": keyword_pairs(msgs, keywords, fuzzy, use_jw).select("_row", "keyword")}
    col_of = {"groups": "Groups", "sectors": "Sectors", "statuses": "Statuses"}
    for kind in kinds:
        if categories is not None:
            pairs[col_of[kind]] = category_pairs(msgs, categories, kind, mode, phrases, on_conflict)
    out = attach_lists(msgs, pairs)
    for c in ("Groups", "Sectors", "Statuses"):
        if c not in out.columns:
            out = out.withColumn(c, F.array().cast("array<string>"))
    return out


def keyword_messages(tagged: DataFrame) -> DataFrame:
    """S14 keyword rows: one row per (message, keyword) with the message's
    source, sentence, language, time and locations (the keyword sink's shape).
    Keyword rows always go out; sentence rows are gated by ``emit_sentence``."""
    cols = [c for c in ("Source", "Sentence", "Language", "Created", "Locations") if c in tagged.columns]
    return tagged.select("MessageId", *cols, F.explode("Keywords").alias("Keyword"))
