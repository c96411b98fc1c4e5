"""Where a message was written from.

Gazetteer lookups reuse the vocabulary-level matcher: each distinct
(lang, token) is matched once against the broadcast gazetteer and the first
hit in gazetteer order (``seq``) is kept (``min_by``), then joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.geo import geo_point
from tidewatch.operators.common import checked_broadcast, cut_lineage, small_side
from tidewatch.operators.matching import match_terms


def first_match(terms: DataFrame, gazetteer: DataFrame, prefer_exact: bool = False, use_jw: bool = False) -> DataFrame:
    """(lang, term) → first gazetteer entry (lat, lon, name) that fuzzy-matches.

    Default parity: first in gazetteer order even over a later exact hit
    (Q21); ``prefer_exact`` ranks exact hits first.
    """
    gz = gazetteer.select("lang", F.col("name").alias("key"), "lat", "lon", "seq")
    hits = match_terms(terms, gz.select("lang", "key"), fuzzy=True, use_jw=use_jw)
    hits = hits.join(checked_broadcast(gz), ["lang", "key"])
    order = F.struct((~F.col("exact")).alias("ne"), F.col("seq")) if prefer_exact else F.struct(F.col("seq"))
    return hits.groupBy("lang", "term").agg(
        F.min_by(F.struct(F.col("key").alias("name"), "lat", "lon"), order).alias("hit")
    ).select("lang", "term", "hit.name", "hit.lat", "hit.lon")


def locate_by_content(msgs: DataFrame, gazetteer: DataFrame, prefer_exact: bool = False) -> DataFrame:
    """(row, term, name, lat, lon) per distinct token of length >= 2 that
    hits the gazetteer of the message's language."""
    toks = msgs.select(
        "_row", F.col("Language").alias("lang"), F.explode(F.array_distinct("tok")).alias("term")
    ).filter(F.length("term") >= 2)
    m = first_match(toks.select("lang", "term"), gazetteer, prefer_exact)
    return toks.join(small_side(m), ["lang", "term"]).select("_row", "term", "name", "lat", "lon")


def locate_by_user_text(msgs: DataFrame, gazetteer: DataFrame, text_col: str = "geo") -> DataFrame:
    """The whole (lower-cased) user location text as one term → (row, name, lat, lon)."""
    t = msgs.select("_row", F.col("Language").alias("lang"), F.lower(F.col(text_col)).alias("term")).filter(
        F.length("term") >= 2
    )
    m = first_match(t.select("lang", "term"), gazetteer)
    return t.join(small_side(m), ["lang", "term"]).select("_row", "name", "lat", "lon")


def lookup_user_location(msgs: DataFrame, users: DataFrame) -> DataFrame:
    """author's home location for tweets with a user id → (row, lat, lon, confidence).

    ``users`` is (user_id, location struct<lat,lon,confidence>); a missing
    user or location gives no row. A shuffle (or broadcast, if AQE finds the
    users side small) join on user id; works stream-static too.
    """
    tw = msgs.filter((F.col("Source") == "twitter") & F.col("user_id").isNotNull()).select("_row", "user_id")
    u = users.select(F.col("user_id").cast("string").alias("user_id"), "location").filter(
        F.col("location.lat").isNotNull()
    )
    return tw.join(u, "user_id").select(
        "_row", F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"),
        F.col("location.confidence").alias("confidence"),
    )


def _loc(lat, lon, p, kind) -> Column:
    return F.struct(
        lat.cast("double").alias("lat"), lon.cast("double").alias("lon"),
        F.lit(p).cast("double").alias("probability") if not isinstance(p, Column) else p.cast("double").alias("probability"),
        F.lit(kind).alias("inference_type"),
    )


def resolve_locations(
    msgs: DataFrame,
    gazetteer: DataFrame,
    users: DataFrame | None = None,
    geo_order: str = "latlon",
) -> DataFrame:
    """The location cascade; returns ``msgs`` with a ``Locations`` array.

    1. ``geo`` blank → untagged. Tweets: ``{}``/unparsable/no point →
       untagged, else ``Tagged`` p=1. Other sources: the text hits the
       gazetteer (J4) → ``UserTagged`` p=1, else untagged.
    2. Untagged → every J3 hit as ``Content`` p=1 (one per matching token, in
       the order of the tokens).
    3. Tweets with a user id: the author's location (J5) is appended as
       ``TwitterUserHandle`` with p = confidence, even when step 1 hit.

    The message plan is read once for all lookups: the narrow columns they need
    (points parsed, texts as terms) are stored, and both term → hit maps, the
    content hits and the author locations come from that copy. Hits of steps 2-3
    are folded per message and joined back once; step 1 is row-local (points, and
    the user-text map by broadcast), so it needs no key. ``_row`` must be the same
    whenever ``msgs`` is evaluated (a unique column or a stored copy, see
    ``with_row_key``).
    ``msgs`` needs _row, Source, Language, geo, is_geojson, user_id, tok.
    """
    blank = F.col("geo").isNull() | F.col("geo").rlike(r"^\s*$")
    point = F.when(~blank & F.col("is_geojson"), geo_point("geo", geo_order))
    user_text = F.when(~blank & ~F.col("is_geojson") & (F.length(F.lower("geo")) >= 2), F.lower("geo"))
    narrow = cut_lineage(msgs.select(
        "_row", "Source", "Language", "user_id", F.array_distinct("tok").alias("tok"),
        point.alias("_pt"), user_text.alias("_ut"),
    ))
    ut_terms = narrow.filter(F.col("_ut").isNotNull()).select(F.col("Language").alias("lang"), F.col("_ut").alias("term"))
    ut_map = small_side(first_match(ut_terms, gazetteer)).select(
        F.col("lang").alias("_ul"), F.col("term").alias("_uterm"), F.struct("lat", "lon").alias("_uh")
    )

    def staged(df: DataFrame) -> DataFrame:
        """Step 1 on rows with ``_pt`` and ``_ut``: adds ``_primary``."""
        primary = F.when(
            F.col("_pt").isNotNull(), F.array(_loc(F.col("_pt.lat"), F.col("_pt.lon"), 1.0, "Tagged"))
        ).when(F.col("_uh").isNotNull(), F.array(_loc(F.col("_uh.lat"), F.col("_uh.lon"), 1.0, "UserTagged")))
        hit = df.join(ut_map, (F.col("Language") == F.col("_ul")) & (F.col("_ut") == F.col("_uterm")), "left")
        return hit.withColumn("_primary", primary).drop("_ul", "_uterm", "_uh", "_pt", "_ut")

    toks = staged(narrow).filter(F.col("_primary").isNull()).select(
        "_row", F.col("Language").alias("lang"), F.posexplode("tok").alias("pos", "term")
    ).filter(F.length("term") >= 2)
    c_map = small_side(first_match(toks.select("lang", "term"), gazetteer))
    extras = toks.join(c_map, ["lang", "term"]).select(
        "_row", F.lit(1).alias("ord"), "pos", _loc(F.col("lat"), F.col("lon"), 1.0, "Content").alias("l")
    )
    if users is not None:
        extras = extras.unionByName(lookup_user_location(narrow, users).select(
            "_row", F.lit(2).alias("ord"), F.lit(0).alias("pos"),
            _loc(F.col("lat"), F.col("lon"), F.col("confidence"), "TwitterUserHandle").alias("l"),
        ))
    folded = extras.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("ord", "pos", "l"))).alias("_x")).select(
        "_row", F.transform("_x", lambda e: e["l"]).alias("_x"))
    empty = F.array().cast("array<struct<lat:double,lon:double,probability:double,inference_type:string>>")
    out = staged(msgs.withColumn("_pt", point).withColumn("_ut", user_text)).join(folded, "_row", "left")
    return out.withColumn(
        "Locations", F.concat(F.coalesce("_primary", empty), F.coalesce("_x", empty))).drop("_primary", "_x")


def track_filter(
    msgs: DataFrame,
    terms: list[str] | None = None,
    langs: list[str] | None = None,
    box: tuple[float, float, float, float] | None = None,
    combine: str = "any",
    text_col: str = "Sentence",
) -> DataFrame:
    """Keep messages matching the stream filter spec.

    Terms: the lower-cased text contains a term. Box: the message point
    (columns lat/lon) lies in the box. ``combine`` = "any" (term OR box) or
    "all" (term AND box); a language list is always ANDed (Q13).
    """
    from tidewatch.functions.geo import in_bbox

    conds = []
    if terms:
        arr = F.array(*[F.lit(t.lower()) for t in terms])
        conds.append(F.exists(arr, lambda t: F.lower(F.col(text_col)).contains(t)))
    if box is not None:
        conds.append(F.coalesce(in_bbox("lat", "lon", box), F.lit(False)))
    cond = None
    for c in conds:
        cond = c if cond is None else (cond | c if combine == "any" else cond & c)
    if langs:
        lc = F.col("Language").isin(list(langs))
        cond = lc if cond is None else cond & lc
    return msgs if cond is None else msgs.filter(cond)
