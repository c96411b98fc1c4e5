"""Stated intents of the reference without code (X1-X4, X6); X5 is in streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.common import checked_broadcast, small_side
from tidewatch.operators.matching import match_terms


def tile_id(lat, lon, size: float) -> F.Column:
    """Grid cell of a point: 'floor(lat/size)_floor(lon/size)'."""
    la = F.col(lat) if isinstance(lat, str) else lat
    lo = F.col(lon) if isinstance(lon, str) else lon
    return F.concat_ws("_", F.floor(la / size).cast("string"), F.floor(lo / size).cast("string"))


def with_tiles(messages: DataFrame, size: float) -> DataFrame:
    """One row per (message, distinct tile of its Locations)."""
    t = F.array_distinct(F.transform("Locations", lambda l: tile_id(l["lat"], l["lon"], size)))
    return messages.withColumn("tile", F.explode(t))


def category_confidence(cands: DataFrame, categories: DataFrame, kind: str) -> DataFrame:
    """Per (row, category): matched keywords / keywords of the category."""
    cat = categories.filter(F.col("kind") == kind)
    need = cat.groupBy("lang", "category").agg(F.countDistinct("keyword").alias("need"))
    table = cat.select("lang", F.col("keyword").alias("term"), "category").distinct()
    hits = cands.select("_row", "lang", "term").join(checked_broadcast(table), ["lang", "term"]).groupBy(
        "_row", "lang", "category").agg(F.countDistinct("term").alias("have"))
    return hits.join(checked_broadcast(need), ["lang", "category"]).select(
        "_row", "category", (F.col("have") / F.col("need")).alias("confidence"))


def translate_terms(pairs: DataFrame, translations: DataFrame, term_col: str = "keyword",
                    lang_col: str = "lang") -> DataFrame:
    """Replace terms by their canonical form where a translation exists
    (``translations`` has one canonical form a term, as S8 gives them)."""
    tr = translations.select(F.col("lang").alias(lang_col), F.col("term").alias(term_col), "canonical")
    return pairs.join(checked_broadcast(tr), [lang_col, term_col], "left").withColumn(
        "canonical", F.coalesce("canonical", F.col(term_col)))


def fuzzy_categories(cands: DataFrame, categories: DataFrame, kind: str, on_conflict: str = "last") -> DataFrame:
    """J2 over the fuzzy term map: a token that fuzzy-matches a category
    keyword assigns the category → (row, category)."""
    from tidewatch.sources.refdata import resolve_categories

    cat = resolve_categories(categories.filter(F.col("kind") == kind), on_conflict)
    keys = cat.select("lang", F.col("keyword").alias("key"), F.size(F.split("keyword", " ")).alias("n")).distinct()
    mapping = small_side(match_terms(cands, keys, fuzzy=True, by_words=True))
    hits = cands.join(mapping, ["lang", "n", "term"]).join(
        checked_broadcast(cat.select("lang", F.col("keyword").alias("key"), "category")), ["lang", "key"])
    return hits.select("_row", "category").distinct()
