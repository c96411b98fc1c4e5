"""Reference data: keyword, category and gazetteer dictionaries.

Files live under ``<root>/<kind>/<lang>/<file>``; the language is the parent
folder. Loaders take a DataFrame of lines ``(lang, value, seq)`` so the same
code serves files and lines derived from tables; ``seq`` is the load order
(file path, then line number) used for last-wins and first-match rules.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.operators.common import numbered

# Fixed value: a language folder name is the parent directory of the file.
LANG_FROM_PATH = r"/([^/]+)/[^/]+$"


def read_refdata_lines(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """S3: every line of ``<root>/<kind>/<lang>/<file>`` as (lang, value, path, seq).

    Files in folders deeper than one language level are left out (by their path,
    so Spark doesn't open them). ``seq``
    numbers the lines of all files by (file path, place in the file): a file may
    be read as several blocks, each in its own task, so lines are numbered
    within their block and blocks are put in order by path and offset (one row
    per block of a dictionary file).
    """
    raw = (
        spark.read.text(f"{root.rstrip('/')}/{kind}/*/*")
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"))
        .filter(F.col("path").rlike(rf"/{re.escape(kind)}/[^/]+/[^/]+$"))
        .withColumn("lang", F.regexp_extract("path", LANG_FROM_PATH, 1))
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    before = Window.orderBy("path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = raw.groupBy("path", "_block").agg(F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_n")).select(
        "path", "_block", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return raw.join(F.broadcast(blocks), ["path", "_block"]).select(
        "lang", "value", "path", (F.col("_before") + F.col("_pos") - F.col("_start") + 1).alias("seq")
    )


def _fields(value) -> F.Column:
    return F.transform(F.split(F.lower(value), ",", -1), lambda s: F.trim(s))


def load_keywords(lines: DataFrame) -> DataFrame:
    """S4 + W5: lower, split on ',', trim, set union per language → (lang, keyword)."""
    return (
        lines.select("lang", F.explode(_fields(F.col("value"))).alias("keyword"))
        .distinct()
    )


def load_categories(lines: DataFrame, kind: str, header: bool = False) -> DataFrame:
    """Field 0 = category, the rest keywords → (kind, lang, category, keyword, seq).

    All (category, keyword) rows are kept; ``resolve_categories`` applies the
    last-wins rule. ``header=True`` skips the first line of each language.
    """
    if header:
        first = lines.groupBy("lang").agg(F.min("seq").alias("_first"))
        lines = lines.join(first, "lang").filter(F.col("seq") != F.col("_first")).drop("_first")
    f = lines.select("lang", "seq", _fields(F.col("value")).alias("f"))
    return f.select(
        F.lit(kind).alias("kind"),
        "lang",
        F.col("f")[0].alias("category"),
        F.explode(F.slice("f", F.lit(2), F.size("f"))).alias("keyword"),
        "seq",
    )


def resolve_categories(categories: DataFrame, on_conflict: str = "last") -> DataFrame:
    """Q3: a keyword listed under several categories keeps the last (default)
    or all of them. Returns (kind, lang, keyword, category, seq)."""
    if on_conflict == "all":
        return categories.select("kind", "lang", "keyword", "category", "seq")
    return categories.groupBy("kind", "lang", "keyword").agg(
        F.max_by("category", "seq").alias("category"), F.max("seq").alias("seq")
    )


def load_gazetteer(lines: DataFrame) -> DataFrame:
    """``name,lat,lon`` lines with exactly 3 fields; name lower-cased (not
    trimmed), numbers trimmed; last value wins, match order = first line.

    Returns (lang, name, lat, lon, seq) with ``seq`` = first line of the name.
    """
    f = lines.select("lang", "seq", F.split("value", ",", -1).alias("f")).filter(F.size("f") == 3)
    rows = f.select(
        "lang",
        "seq",
        F.lower(F.col("f")[0]).alias("name"),
        F.expr("try_cast(trim(f[1]) AS DOUBLE)").alias("lat"),
        F.expr("try_cast(trim(f[2]) AS DOUBLE)").alias("lon"),
    ).filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return rows.groupBy("lang", "name").agg(
        F.max_by(F.struct("lat", "lon"), "seq").alias("p"), F.min("seq").alias("seq")
    ).select("lang", "name", "p.lat", "p.lon", "seq")


def _track_terms(keyword_lines: DataFrame) -> DataFrame:
    return keyword_lines.select(
        "seq", F.posexplode(F.split("value", ",", -1)).alias("i", "term")
    ).select("seq", "i", F.trim(F.lower("term")).alias("term"))


def track_list(keyword_lines: DataFrame, cap: int | None = None) -> DataFrame:
    """S7 + W4: (pos, term) of all keyword terms of all languages in file/line order.

    ``cap`` is for a stream filter that accepts a bounded term list: when there
    are more than ``cap`` terms, the first ``cap - 1`` are kept, and
    ``track_list_dropped`` gives the others. No cap by default.
    """
    if cap is None:
        return numbered(_track_terms(keyword_lines), ["seq", "i"]).select("pos", "term")
    head = _track_terms(keyword_lines).orderBy("seq", "i").limit(cap + 1)  # per-partition top-k, then merge
    w = Window.orderBy("seq", "i")
    kept = head.withColumn("pos", F.row_number().over(w)).withColumn(
        "total", F.count(F.lit(1)).over(Window.partitionBy())
    )
    return kept.filter((F.col("total") <= cap) | (F.col("pos") <= cap - 1)).select(
        F.col("pos").cast("long").alias("pos"), "term"
    )


def track_list_dropped(keyword_lines: DataFrame, cap: int) -> DataFrame:
    """(pos, term) of the terms that ``track_list`` with this cap leaves out."""
    every = track_list(keyword_lines)
    over = every.agg(F.max("pos").alias("total"))
    return every.join(F.broadcast(over)).filter((F.col("total") > cap) & (F.col("pos") >= cap)).select("pos", "term")


def build_dictionaries(sheet: DataFrame) -> dict[str, DataFrame]:
    """Keyword sheet (lang, term, synonyms, english, seq) → keyword lists and a
    term → English translation map.

    ``synonyms`` is a comma-separated list. Outputs ``keywords`` (lang,
    keyword) and ``translations`` (lang, term, canonical): one canonical form
    per term, that of its last line by ``seq``.
    """
    exploded = sheet.select(
        "lang",
        "english",
        "seq",
        F.explode(F.concat(F.array("term"), F.split(F.coalesce("synonyms", F.lit("")), ","))).alias("t"),
    ).select("lang", "english", "seq", F.lower(F.trim("t")).alias("t")).filter(F.length("t") > 0)
    kw = exploded.select("lang", F.col("t").alias("keyword")).distinct()
    tr = exploded.groupBy("lang", F.col("t").alias("term")).agg(F.max_by(F.lower("english"), "seq").alias("canonical"))
    return {"keywords": kw, "translations": tr}
