"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole driver tables through a fixture of
``tidewatch.plans.fixtures`` and runs one operator (or a whole job) on it.
Result columns are flat so they can be compared with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import timeseries as ts
from tidewatch.plans import fixtures as fx
from tidewatch.sources.tables import spread, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


MSG = {"events": fx.msg_events, "lines": fx.msg_lines, "repeats": fx.msg_repeats}


# ------------------------------------------------------------ M1: trend job

def _trend(spark, root, fixture):
    return ts.trend_tables(MSG[fixture](spark, root))


def timeseries_long_q(fixture: str) -> Query:
    return lambda spark, root: ts.timeseries_long(MSG[fixture](spark, root))


REGISTRY["timeseries_long"] = timeseries_long_q("events")  # the flagship, as in entry()
for _fix in ("events", "lines", "repeats"):
    REGISTRY[f"timeseries_long_{_fix}"] = timeseries_long_q(_fix)


@register("section_counts")
def section_counts(spark, root):
    return _trend(spark, root, "lines")["counts"]


@register("section_counts_repeats")
def section_counts_repeats(spark, root):
    return _trend(spark, root, "repeats")["counts"]


@register("distinct_timespans")
def distinct_timespans(spark, root):
    return ts.distinct_timespans(_trend(spark, root, "lines")["spans"])


@register("topk_per_timespan")
def topk_per_timespan(spark, root):
    return _trend(spark, root, "lines")["topk"]


@register("topk_per_timespan_events")
def topk_per_timespan_events(spark, root):
    return _trend(spark, root, "events")["topk"]


@register("hourly_counts")
def hourly_counts(spark, root):
    return _trend(spark, root, "events")["hourly"].drop("hour")


@register("timeseries_documents")
def timeseries_documents(spark, root):
    docs = ts.timeseries_documents(ts.timeseries_long(fx.msg_events(spark, root)))
    return docs.select(
        "timespan",
        F.array_join("labels", ",").alias("labels"),
        F.to_json("graphData").alias("graph_data"),
    )


@register("timeseries_documents_lines")
def timeseries_documents_lines(spark, root):
    docs = ts.timeseries_documents(ts.timeseries_long(fx.msg_lines(spark, root)))
    return docs.select(
        "timespan",
        F.array_join("labels", ",").alias("labels"),
        F.to_json("graphData").alias("graph_data"),
    )


# ------------------------------------------------------------ M2/M3: tagging

from tidewatch.functions import fuzzy as fz  # noqa: E402
from tidewatch.functions.text import ngrams as _ngrams  # noqa: E402
from tidewatch.operators import lemmas as lm  # noqa: E402
from tidewatch.operators import tagging as tg  # noqa: E402
from tidewatch.operators import track as tk  # noqa: E402
from tidewatch.operators.matching import fuzzy_pairs  # noqa: E402
from tidewatch.sources import refdata as rd  # noqa: E402


def _routed(env: DataFrame) -> DataFrame:
    return tg.with_tokens(tg.route_source(env)).withColumn("_row", F.col("MessageId"))


@register("tokens")
def tokens(spark, root):
    m = _routed(fx.docs_envelopes(spark, root))
    d = F.array_distinct("tok")
    return m.select(
        F.col("MessageId").cast("long").alias("doc_id"),
        F.size("tok").cast("long").alias("n_tokens"),
        F.size(d).cast("long").alias("n_distinct"),
        F.md5(F.array_join(d, "|")).alias("tokens_md5"),
    )


@register("tokens_mixed")
def tokens_mixed(spark, root):
    """F1 on both routes: tokens come from ``message.text`` also where the
    sentence differs from it."""
    m = _routed(fx.mixed_envelopes(spark, root))
    return m.select(
        F.col("MessageId").cast("long").alias("doc_id"),
        F.md5(F.array_join("tok", "|")).alias("tokens_md5"),
    )


@register("ngrams")
def ngrams(spark, root):
    m = _routed(fx.docs_envelopes(spark, root))
    bi, tri = _ngrams("tok", 2), _ngrams("tok", 3)
    return m.select(
        F.col("MessageId").cast("long").alias("doc_id"),
        F.size(bi).cast("long").alias("n_bigrams"),
        F.size(F.array_distinct(tri)).cast("long").alias("n_trigrams_distinct"),
        F.md5(F.array_join(bi, "|")).alias("bigrams_md5"),
    )


def _pair_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(F.col("_row").cast("long").alias("id"), "keyword").agg(
        F.count(F.lit(1)).alias("n")
    )


@register("match_keywords_exact")
def match_keywords_exact(spark, root):
    m = _routed(fx.part_envelopes(spark, root))
    return _pair_counts(tg.keyword_pairs(m, fx.part_keywords(spark), fuzzy=False))


@register("match_keywords_fuzzy")
def match_keywords_fuzzy(spark, root):
    m = _routed(fx.part_envelopes(spark, root))
    return _pair_counts(tg.keyword_pairs(m, fx.part_keywords(spark), fuzzy=True))


@register("match_phrases")
def match_phrases(spark, root):
    m = _routed(fx.part_envelopes(spark, root))
    pairs = tg.keyword_pairs(m, fx.part_keywords(spark), fuzzy=True)
    return _pair_counts(pairs.filter(F.col("keyword").contains(" ")))


@register("match_keywords_docs")
def match_keywords_docs(spark, root):
    m = _routed(fx.docs_envelopes(spark, root))
    return _pair_counts(tg.keyword_pairs(m, fx.doc_keywords(spark), fuzzy=True))


def _doc_candidate_pairs(spark, root) -> DataFrame:
    """Blocked (term, key) pairs of the document vocabulary vs the document
    dictionary: share a 4-gram, compatible lengths, max length >= 5."""
    m = _routed(fx.docs_envelopes(spark, root))
    vocab = m.select(F.col("Language").alias("lang"), F.explode(F.array_distinct("tok")).alias("term")).distinct()
    keys = fx.doc_keywords(spark).select("lang", F.col("keyword").alias("key"))
    kg = keys.select("lang", "key", F.explode(fz.grams("key")).alias("gram"))
    vg = vocab.select("lang", "term", F.explode(fz.grams("term")).alias("gram"))
    return (
        vg.join(F.broadcast(kg), ["lang", "gram"])
        .select("term", "key")
        .filter(
            (F.greatest(F.length("term"), F.length("key")) >= 5) & fz.lengths_compatible("term", "key")
        )
        .distinct()
    )


@register("lcs_length")
def lcs_length(spark, root):
    p = _doc_candidate_pairs(spark, root)
    return p.select("term", "key", fz.lcs_length("key", "term").cast("long").alias("lcs"))


@register("jaro_winkler")
def jaro_winkler(spark, root):
    p = _doc_candidate_pairs(spark, root)
    return p.select("term", "key", F.round(fz.jaro_winkler("key", "term"), 6).alias("jw"))


@register("fuzzy_pairs_docs")
def fuzzy_pairs_docs(spark, root):
    m = _routed(fx.docs_envelopes(spark, root))
    vocab = m.select(F.col("Language").alias("lang"), F.explode(F.array_distinct("tok")).alias("term"))
    keys = fx.doc_keywords(spark).select("lang", F.col("keyword").alias("key"))
    return fuzzy_pairs(vocab.distinct(), keys).select("lang", "term", "key")


def _cats(spark, lines, kind):
    return rd.load_categories(fx.category_lines(spark, lines), kind)


@register("tag_shuffled")
def tag_shuffled(spark, root):
    """Keywords by message when the input is itself the result of a shuffle:
    ``lineitem`` joined to ``part``, one message per line, grouped afterwards."""
    env = fx.line_envelopes(spark, root)
    tagged = tg.tag_messages(env, fx.part_keywords(spark), None, kinds=())
    return tagged.select("Sentence", F.explode("Keywords").alias("keyword")).groupBy(
        F.col("Sentence").alias("name"), "keyword").agg(F.count(F.lit(1)).alias("n"))


@register("match_groups_any")
def match_groups_any(spark, root):
    m = _routed(fx.part_envelopes(spark, root))
    p = tg.category_pairs(m, _cats(spark, fx.CATEGORY_LINES, "groups"), "groups")
    return p.select(F.col("_row").cast("long").alias("id"), "category")


@register("match_groups_all")
def match_groups_all(spark, root):
    m = _routed(fx.part_envelopes(spark, root))
    p = tg.category_pairs(m, _cats(spark, fx.CATEGORY_ALL_LINES, "groups"), "groups", mode="all")
    return p.select(F.col("_row").cast("long").alias("id"), "category")


@register("match_sectors")
def match_sectors(spark, root):
    m = _routed(fx.part_envelopes(spark, root))
    p = tg.category_pairs(m, _cats(spark, fx.CATEGORY_LINES, "sectors"), "sectors", on_conflict="all")
    return p.select(F.col("_row").cast("long").alias("id"), "category")


@register("match_statuses")
def match_statuses(spark, root):
    m = _routed(fx.part_envelopes(spark, root))
    p = tg.category_pairs(m, _cats(spark, fx.CATEGORY_LINES, "statuses"), "statuses", phrases=False)
    return p.select(F.col("_row").cast("long").alias("id"), "category")


@register("route_source")
def route_source(spark, root):
    r = tg.route_source(fx.mixed_envelopes(spark, root))
    return r.select(
        F.col("MessageId").cast("long").alias("doc_id"),
        "Source",
        "Language",
        F.md5("Sentence").alias("sentence_md5"),
    )


def _part_type_lines(spark, root) -> DataFrame:
    p = table(spark, root, "part")
    return p.select(
        F.lit("en").alias("lang"),
        F.concat(F.upper("p_name"), F.lit(" , "), F.col("p_type"), F.lit(",")).alias("value"),
        F.col("p_partkey").alias("seq"),
    )


@register("keyword_dictionary")
def keyword_dictionary(spark, root):
    return rd.load_keywords(_part_type_lines(spark, root))


@register("category_dictionary")
def category_dictionary(spark, root):
    p = table(spark, root, "part")
    lines = p.select(
        F.lit("en").alias("lang"),
        F.concat_ws(",", "p_brand", "p_name", F.lower("p_type")).alias("value"),
        F.col("p_partkey").alias("seq"),
    )
    cats = rd.resolve_categories(rd.load_categories(lines, "groups"))
    return cats.select("lang", "keyword", "category")


def _track_lines(spark, root) -> DataFrame:
    p = table(spark, root, "part")
    return p.select(F.concat_ws(",", "p_name", "p_type").alias("value"), F.col("p_partkey").alias("seq"))


@register("track_list")
def track_list(spark, root):
    return rd.track_list(_track_lines(spark, root), cap=400)


@register("track_list_uncapped")
def track_list_uncapped(spark, root):
    return rd.track_list(_track_lines(spark, root))


@register("track_list_dropped")
def track_list_dropped(spark, root):
    return rd.track_list_dropped(_track_lines(spark, root), 400)


@register("emit_sentence")
def emit_sentence(spark, root):
    env = fx.part_envelopes(spark, root)
    tagged = tg.tag_messages(env, fx.part_keywords(spark), _cats(spark, fx.CATEGORY_LINES, "groups"))
    out = tg.emit_sentence(tagged)
    return out.select(
        F.col("MessageId").cast("long").alias("id"),
        F.array_join("Keywords", ",").alias("keywords"),
        F.array_join("Groups", ",").alias("groups"),
    )


# ------------------------------------------------------------ M4: geo

from tidewatch.functions import geo as gf  # noqa: E402
from tidewatch.operators import graph as gr  # noqa: E402
from tidewatch.operators import locate as lc  # noqa: E402


def _r4(c):
    """Centres are rounded once, to 6 places, where they are computed; outputs
    only normalise -0.0 (a second rounding would break ties differently)."""
    return c + F.lit(0.0)


def _geo_msgs(spark, root) -> DataFrame:
    return _routed(fx.geo_customers(spark, root))


def _users_a6(spark, root) -> DataFrame:
    return gr.user_centroid(gr.condense_locations(gr.point_observations(fx.user_obs(spark, root))))


@register("bbox_center")
def bbox_center(spark, root):
    p = fx.place_json(spark, root).select("c_custkey", gf.bbox_center("place").alias("c"))
    return p.select("c_custkey", _r4(F.col("c.lat")).alias("lat"), _r4(F.col("c.lon")).alias("lon"))


@register("geo_center")
def geo_center(spark, root):
    obs = fx.user_obs(spark, root)
    agg = obs.groupBy("user_id").agg(*gf.centre_aggs("lat", "lon"))
    c = gf.centre_from_vector("_cx", "_cy", "_cz")
    return agg.select("user_id", _r4(c["lat"]).alias("lat"), _r4(c["lon"]).alias("lon"))


@register("geo_points")
def geo_points(spark, root):
    m = _geo_msgs(spark, root)
    a, b = gf.geo_point("geo", "latlon"), gf.geo_point("geo", "lonlat")
    return m.select(
        F.col("MessageId").cast("long").alias("id"),
        a["lat"].alias("lat_ll"), a["lon"].alias("lon_ll"), b["lat"].alias("lat_gj"), b["lon"].alias("lon_gj"),
    )


def _content(spark, root, prefer_exact):
    m = _geo_msgs(spark, root)
    h = lc.locate_by_content(m, fx.gaz_nations(spark, root), prefer_exact=prefer_exact)
    return h.select(F.col("_row").cast("long").alias("id"), "term", "name", "lat", "lon")


@register("locate_by_content")
def locate_by_content(spark, root):
    return _content(spark, root, False)


@register("locate_by_content_exact_first")
def locate_by_content_exact_first(spark, root):
    return _content(spark, root, True)


@register("locate_by_user_text")
def locate_by_user_text(spark, root):
    m = _geo_msgs(spark, root).filter(~F.col("is_geojson"))
    h = lc.locate_by_user_text(m, fx.gaz_regions(spark, root))
    return h.select(F.col("_row").cast("long").alias("id"), "name", "lat", "lon")


@register("user_location_join")
def user_location_join(spark, root):
    m = _geo_msgs(spark, root)
    h = lc.lookup_user_location(m, _users_a6(spark, root))
    return h.select(F.col("_row").cast("long").alias("id"), _r4(F.col("lat")).alias("lat"),
                    _r4(F.col("lon")).alias("lon"), "confidence")


@register("resolve_locations")
def resolve_locations(spark, root):
    m = _geo_msgs(spark, root)
    r = lc.resolve_locations(m, fx.gaz_world(spark, root), _users_a6(spark, root), geo_order="latlon")
    e = r.select("_row", F.explode("Locations").alias("l"))
    return e.select(
        F.col("_row").cast("long").alias("id"), F.col("l.inference_type").alias("inference_type"),
        _r4(F.col("l.lat")).alias("lat"), _r4(F.col("l.lon")).alias("lon"), F.col("l.probability").alias("probability"),
    )


@register("track_filter")
def track_filter(spark, root):
    m = _geo_msgs(spark, root)
    p = gf.geo_point("geo", "latlon")
    m = m.withColumn("lat", p["lat"]).withColumn("lon", p["lon"])
    out = lc.track_filter(m, terms=["asia", "Europe"], langs=["en"], box=(-150.0, -60.0, -60.0, -30.0), combine="any")
    return out.select(F.col("MessageId").cast("long").alias("id"))


# ------------------------------------------------------------ M5: graph

@register("condense_locations")
def condense_locations(spark, root):
    c = gr.condense_locations(gr.point_observations(fx.user_obs(spark, root)))
    return c.select("user_id", "key", "occurrences")


@register("user_centroid")
def user_centroid(spark, root):
    u = _users_a6(spark, root)
    return u.select("user_id", _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"),
                    F.col("location.confidence").alias("confidence"))


@register("reply_edges")
def reply_edges(spark, root):
    return gr.reply_edges(fx.edges_orders(spark, root), "src", "dst")


@register("adjacency")
def adjacency(spark, root):
    return gr.adjacency(gr.reply_edges(fx.edges_orders(spark, root), "src", "dst"))


@register("adjacency_lists")
def adjacency_lists(spark, root):
    return gr.adjacency_rows(gr.reply_edges(fx.edges_orders(spark, root), "src", "dst"))


def _propagated(spark, root, iterations):
    return gr.propagate_locations(fx.edges_orders(spark, root), fx.supplier_anchors(spark, root), iterations)


def _users_out(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id", _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"),
        F.col("location.confidence").alias("confidence"), F.size("inferred").cast("long").alias("n_inferred"),
    )


@register("propagate_1")
def propagate_1(spark, root):
    return _users_out(_propagated(spark, root, 1)["users"])


@register("propagate_5")
def propagate_5(spark, root):
    return _users_out(_propagated(spark, root, 5)["users"])


@register("propagation_metrics")
def propagation_metrics(spark, root):
    m = _propagated(spark, root, 5)["metrics"]
    return m.select(F.col("iteration").cast("int").alias("iteration"), F.col("processed").cast("long").alias("processed"),
                    F.col("inferences").cast("long").alias("inferences"))


def _click_users(spark, root):
    ev = fx.events_k(table(spark, root, "events")).filter(F.col("event_type") == "click")
    clicks = ev.select(F.col("user_id").cast("string").alias("user_id"), (F.col("k") - 50).cast("double").alias("lat"),
                       ((F.col("k") * 3) % 360 - 180).cast("double").alias("lon"))
    return gr.user_centroid(gr.condense_locations(gr.point_observations(clicks)), weighted=True).select(
        "user_id", F.struct(F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"),
                            F.lit(0.5).alias("confidence")).alias("location"))


@register("merge_users")
def merge_users(spark, root):
    m = gr.merge_users(_users_a6(spark, root), _click_users(spark, root))
    return m.select("user_id", _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"),
                    F.col("location.confidence").alias("confidence"))


# ------------------------------------------------------------ M6: ingest and streams

from tidewatch import schema as S  # noqa: E402
from tidewatch.sources import messages as ms  # noqa: E402
from tidewatch.sources import tweets as tw  # noqa: E402
from tidewatch.streaming import pipelines as sp  # noqa: E402


def _raw_tweets_read(spark, root) -> DataFrame:
    return spark.read.schema(S.RAW_TWEET).json(fx.tweet_json_dir(spark, root))


@register("tweet_row")
def tweet_row(spark, root):
    r = tw.tweet_row(_raw_tweets_read(spark, root))
    return r.select("epoch_day", "id", "user_id", "user_screen_name", "timestamp", "lang", "in_reply_to",
                    F.md5("text").alias("text_md5"), "geo")


@register("tweet_envelope")
def tweet_envelope(spark, root):
    e = tw.tweet_envelope(_raw_tweets_read(spark, root))
    return e.select(
        F.col("message.id").cast("long").alias("id"), "created_at", "source", F.col("message.lang").alias("lang"),
        F.col("message.user_id").alias("user_id"), F.md5("message.text").alias("text_md5"),
    )


@register("dedup_insert")
def dedup_insert(spark, root):
    rows = tw.tweet_row(_raw_tweets_read(spark, root))
    path = fx.new_scratch(spark, "tweet-table")
    tw.write_tweets(spark, rows, path)
    resent = rows.filter(F.col("geo").isNotNull()).withColumn("text", F.lit("resent"))
    stored = tw.write_tweets(spark, resent.unionByName(resent), path)
    return stored.groupBy(F.col("epoch_day").cast("long").alias("epoch_day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("text") == "resent").alias("n_resent"))


@register("replay")
def replay(spark, root):
    rows = tw.tweet_row(_raw_tweets_read(spark, root))
    return tw.replay(rows)


@register("replay_columns")
def replay_columns(spark, root):
    """S13 checked by value: the replayed JSON parsed back to its columns."""
    rows = tw.tweet_row(_raw_tweets_read(spark, root))
    back = tw.replay(rows).select(F.from_json("value", rows.schema).alias("r")).select("r.*")
    return back.select("epoch_day", "id", "user_id", "user_screen_name", "timestamp", "lang", "in_reply_to",
                       F.md5("text").alias("text_md5"), "geo")


@register("bad_records")
def bad_records(spark, root):
    parsed = ms.parse_message_lines(fx.message_lines(spark, root))
    return parsed.groupBy(F.col("_status").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _events_stream(spark, root):
    src = f"{root.rstrip('/')}/events*.parquet"
    schema = spark.read.parquet(f"{root.rstrip('/')}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(src)


def _events_msgs_stream(spark, root):
    ev = fx.events_k(_events_stream(spark, root))
    return ev.select(
        F.col("event_id").cast("string").alias("MessageId"),
        F.col("ts").cast("timestamp").alias("Created"),
        F.array("event_type").alias("Keywords"),
        F.array().cast("array<string>").alias("Sectors"),
        F.array(F.concat(F.lit("k"), (F.col("k") % 7).cast("string"))).alias("Groups"),
        F.array(F.when(F.col("value") >= 100, "high").otherwise("low")).alias("Statuses"),
    )


@register("hourly_stream")
def hourly_stream(spark, root):
    out, ck = fx.new_scratch(spark, "hourly-out"), fx.new_scratch(spark, "hourly-ckpt")
    sp.run_update_to_table(sp.hourly_stream(_events_msgs_stream(spark, root)), out, ck)
    return sp.latest_rows(spark.read.parquet(out), ["hour_ms", "section", "value"])


@register("late_events")
def late_events(spark, root):
    out, ck = fx.new_scratch(spark, "late-out"), fx.new_scratch(spark, "late-ckpt")
    s = sp.late_events(_events_msgs_stream(spark, root))
    sp.run_available_now(s.select("MessageId", "Keywords"), out, ck)
    return spark.read.parquet(out).groupBy(F.col("Keywords")[0].alias("event_type")).agg(
        F.count(F.lit(1)).alias("n"))


@register("stream_tagging")
def stream_tagging(spark, root):
    src = fx.new_scratch(spark, "envelopes")
    fx.part_envelopes(spark, root).write.mode("overwrite").json(src)
    out, ck = fx.new_scratch(spark, "tagged"), fx.new_scratch(spark, "tagged-ckpt")
    stream = sp.message_stream(spark, src, S.ENVELOPES, max_files_per_trigger=1)
    sp.tag_stream(stream, fx.part_keywords(spark), None, out, ck, kinds=())
    t = spark.read.parquet(out)
    return t.select(F.col("MessageId").cast("long").alias("id"), F.explode("Keywords").alias("keyword")).groupBy(
        "id", "keyword").agg(F.count(F.lit(1)).alias("n"))


@register("place_observations")
def place_observations(spark, root):
    """A5 on places: the customers of an account manager (key % 40) seen at their nation's place."""
    p = fx.place_json(spark, root).select(
        (F.col("c_custkey") % 40).alias("user_id"), F.lit(None).cast("string").alias("geo"), "place")
    c = gr.condense_locations(gr.tweet_observations(p))
    return c.select(F.col("user_id").cast("long").alias("user_id"), "kind", "key", "occurrences")


@register("user_state")
def user_state(spark, root):
    """A8 over all tweets: points, reply edges, new users and centres."""
    u = gr.user_state(tw.tweet_row(_raw_tweets_read(spark, root)))
    return u.select(F.col("user_id").cast("long").alias("user_id"), "n_points", "n_places", "n_to", "n_by",
                    _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"))


@register("stream_tagging_located")
def stream_tagging_located(spark, root):
    """E2 on a stream of several micro-batches: keyword sink rows with their locations, read back."""
    src = fx.new_scratch(spark, "located-envelopes")
    fx.geo_customers(spark, root).repartition(3).write.mode("overwrite").json(src)
    paths = {k: fx.new_scratch(spark, f"located-{k}") for k in ("out", "ckpt", "keywords")}
    stream = sp.message_stream(spark, src, S.ENVELOPES, max_files_per_trigger=1)
    regions = fx.gaz_regions(spark, root).select("lang", F.col("name").alias("keyword"))
    sp.tag_stream(stream, regions, None, paths["out"], paths["ckpt"], fx.gaz_world(spark, root), _users_a6(spark, root),
                  keyword_path=paths["keywords"], kinds=())
    rows = spark.read.option("basePath", paths["keywords"]).json(paths["keywords"])
    return rows.groupBy(F.col("Keyword").alias("keyword"), "Source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.size("Locations") > 0).alias("n_located"))


@register("user_state_stream")
def user_state_stream(spark, root):
    src = fx.new_scratch(spark, "obs")
    fx.user_obs(spark, root).repartition(4).write.mode("overwrite").parquet(src)
    state, ck = fx.new_scratch(spark, "user-state"), fx.new_scratch(spark, "user-state-ckpt")
    stream = sp.message_stream(spark, src, spark.read.parquet(src).schema, fmt="parquet", max_files_per_trigger=1)
    sp.user_state_stream(stream, state, ck)
    u = sp.current_users(spark, state)
    return u.select("user_id", _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"),
                    F.col("location.confidence").alias("confidence"))


# ------------------------------------------------------------ M6b: bad input on streams

from tidewatch.streaming import dead_letters as dl  # noqa: E402


def _written_lines(spark, lines: DataFrame, files: int) -> str:
    path = fx.new_scratch(spark, "lines")
    lines.repartition(files).write.text(path)
    return path


@register("fan_out_dead_letters")
def fan_out_dead_letters(spark, root):
    """S10 + S2 on a stream of several micro-batches: keys in the table and both queues, and every dead letter."""
    src = fx.packed_lines(spark, fx.tweet_lines(spark, root), "lines", fx.STREAM_LINES)
    paths = {k: fx.new_scratch(spark, f"fan-{k}") for k in ("root", "table", "graph", "pipeline")}
    dead = dl.fan_out_lines(spark, src, paths["root"], paths["table"], paths["graph"], paths["pipeline"], state_partitions=8,
                            max_bytes_per_trigger=fx.batch_bytes(spark, src, 3), consume=True)

    def ids(df, place, col):
        return df.select(F.lit(place).alias("place"), F.lit(None).cast("string").alias("reason"), F.col(col).cast("string").alias("item"))

    out = ids(spark.read.parquet(paths["table"]), "table", "id")
    out = out.unionByName(ids(spark.read.json(paths["graph"]), "graph", "id"))
    out = out.unionByName(ids(spark.read.schema("message struct<id: string>").json(paths["pipeline"]), "pipeline", "message.id"))
    out = out.unionByName(dead.select(F.lit("dead").alias("place"), "reason", F.md5("line").alias("item")))
    return out.groupBy("place", "reason", "item").agg(F.count(F.lit(1)).alias("n"))


@register("tag_dead_letters")
def tag_dead_letters(spark, root):
    """T2 with bounded retries: after the first round "fr" gets its dictionary, "xx" never does."""
    src = _written_lines(spark, fx.envelope_lines(spark, root), 2)
    work, out = fx.new_scratch(spark, "tag-work"), fx.new_scratch(spark, "tag-out")
    en = fx.part_keywords(spark)
    both = en.unionByName(en.withColumn("lang", F.lit("fr")))
    args = {"max_attempts": 3, "max_files_per_trigger": 1, "state_partitions": 8, "kinds": ()}
    dl.tag_lines(spark, src, work, lambda: en, None, out, rounds=1, **args)
    dead = dl.tag_lines(spark, src, work, lambda: both, None, out, **args)
    good = spark.read.parquet(out).select(
        F.col("MessageId").cast("long").alias("id"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("int").alias("attempt"),
        F.coalesce(F.greatest(F.size("Keywords"), F.lit(0)), F.lit(0)).cast("long").alias("n_keywords"))
    bad = dead.select(F.regexp_extract("line", '"id":"([0-9]+)"', 1).cast("long").alias("id"), "reason", "attempt",
                      F.lit(None).cast("long").alias("n_keywords"))
    return good.unionByName(bad)


# ------------------------------------------------------------ M6c: state kept current

from tidewatch.sources import merge_table as mt  # noqa: E402
from tidewatch.streaming import archives as ar  # noqa: E402
from tidewatch.streaming import live_series as ls  # noqa: E402
from tidewatch.streaming import user_state as us  # noqa: E402


@register("merge_table")
def merge_table(spark, root):
    """S11 as a write: centres of all users, then the weighted centres of clicks merged in (the first
    merge repeated under its token), read back from the current version."""
    path = fx.new_scratch(spark, "users-table")
    for token in (0, 0):
        mt.merge(spark, path, _users_a6(spark, root), ["user_id"], token=token)
    mt.merge(spark, path, _click_users(spark, root), ["user_id"], token=1)
    m = mt.read_table(spark, path)
    return m.select("user_id", _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"),
                    F.col("location.confidence").alias("confidence"))


@register("user_state_live")
def user_state_live(spark, root):
    """T3 over all tweets: two micro-batches, and two more with the second half of the files after a restart."""
    src, read = fx.new_scratch(spark, "live-tweets"), 0
    rows = tw.tweet_row(_raw_tweets_read(spark, root))
    halves = [rows.filter(F.pmod(F.xxhash64("id"), F.lit(2)) == i) for i in (0, 1)]
    table_path, ck = fx.new_scratch(spark, "live-users"), fx.new_scratch(spark, "live-ckpt")
    for half in halves:
        spread(half, 2).write.mode("append").option("compression", "zstd").parquet(src)
        bound = fx.batch_bytes(spark, src, 2, but=read)
        stream = sp.message_stream(spark, src, rows.schema, fmt="parquet", max_bytes_per_trigger=bound)
        us.run_user_state(spark, stream, table_path, ck, state_partitions=8, buckets=8)
        read = fx.total_bytes(spark, src)
    u = us.current_user_state(spark, table_path)
    return u.select(F.col("user_id").cast("long").alias("user_id"), "n_points", "n_places", "n_to", "n_by",
                    _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"))


@register("timeseries_live")
def timeseries_live(spark, root):
    """X5 over all messages: the documents after four micro-batches and a restart."""
    src, work, out = (fx.new_scratch(spark, f"live-{k}") for k in ("messages", "series", "documents"))
    msgs = fx.msg_events(spark, root)
    for half in (0, 1):
        part = msgs.filter(F.pmod(F.xxhash64("MessageId"), F.lit(2)) == half)
        # row groups of a bounded size: a micro-batch is one file, which many tasks can read
        part.repartition(2).write.mode("append").option("parquet.block.size", fx.ROW_GROUP_BYTES).parquet(src)
        stream = sp.message_stream(spark, src, msgs.schema, fmt="parquet", max_files_per_trigger=1)
        ls.run_live_series(spark, stream, work, out, buckets=8)
    return spark.read.text(out).select("name", F.md5("value").alias("doc_md5"))


@register("late_archives")
def late_archives(spark, root):
    """S15 + T1: two archives with checkpoints of their own, three arrivals each: the first half of the events
    (every fifth delivered twice), the second half, and copies that are more than 10 s behind the first half."""
    ev = fx.events_k(table(spark, root, "events", spread_small=True)).withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    bounds = ev.agg(F.min("ms").alias("a"), F.max("ms").alias("b")).first()
    half = F.col("ms") * 2 <= (bounds.a or 0) + (bounds.b or 0)
    last = ev.filter(half).agg(F.max("ms").alias("m")).first().m or 0
    first = ev.filter(half)
    late = ev.filter((F.col("ms") < last - 10_000) & (F.col("k") % 3 == 0)).withColumn("event_id", -F.col("event_id") - 1)
    arrivals = [first.unionByName(first.filter("k % 5 = 0")), ev.filter(~half), late]
    columns = {
        "messages": (F.lit(True), [F.col("event_id").cast("string").alias("key"), F.col("event_type").alias("Keyword")]),
        "tweets": (F.col("event_type") != "error", [F.col("event_id").cast("string").alias("key"), F.col("user_id").cast("string").alias("user_id")]),
    }
    out = []
    for name, (wanted, cols) in columns.items():
        src, path, ck = (fx.new_scratch(spark, f"archive-{name}-{k}") for k in ("in", "out", "ckpt"))
        counts = {}
        for rows in arrivals:
            rows.filter(wanted).select(*cols, F.timestamp_millis("ms").alias("at")).write.mode("append").parquet(src)
            stream = sp.message_stream(spark, src, spark.read.parquet(src).schema, fmt="parquet")
            for what, n in ar.run_archive(stream, path, ck, "at", "key").items():
                counts[what] = counts.get(what, 0) + n
        kept = spark.read.schema("key string").json(path)
        found = kept.agg(F.count("*").alias("kept"), F.coalesce(F.sum(F.col("key").cast("long")), F.lit(0)).alias("kept_ids"))
        out.append(found.select(F.lit(name).alias("archive"), "kept", "kept_ids", *[F.lit(n).cast("long").alias(w) for w, n in counts.items()]))
    return out[0].unionByName(out[1])


# ------------------------------------------------------------ M7: extensions and remaining operators

from tidewatch.functions.timeutil import hour_ms as _hour_ms, timespan_label as _label  # noqa: E402
from tidewatch.operators import extensions as ext  # noqa: E402

TILE_SIZE = 30.0


@register("tile_timeseries")
def tile_timeseries(spark, root):
    m = ext.with_tiles(fx.msg_events_located(spark, root), TILE_SIZE)
    return ts.timeseries_long(m, extra=("tile",))


@register("category_confidence")
def category_confidence(spark, root):
    m = _routed(fx.part_envelopes(spark, root))
    cands = tg.candidates(m, 2)
    c = ext.category_confidence(cands, _cats(spark, fx.CATEGORY_ALL_LINES, "groups"), "groups")
    return c.select(F.col("_row").cast("long").alias("id"), "category", F.round("confidence", 6).alias("confidence"))


@register("translated_terms")
def translated_terms(spark, root):
    m = _routed(fx.docs_envelopes(spark, root))
    pairs = tg.keyword_pairs(m, fx.doc_keywords(spark)).join(
        m.select("_row", F.col("Language").alias("lang")), "_row")
    t = ext.translate_terms(pairs, fx.doc_translations(spark))
    return t.groupBy(F.col("_row").cast("long").alias("id"), "canonical").agg(F.count(F.lit(1)).alias("n"))


@register("weighted_centroid")
def weighted_centroid(spark, root):
    c = gr.condense_locations(gr.point_observations(fx.user_obs(spark, root)))
    u = gr.user_centroid(c, weighted=True)
    return u.select("user_id", _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"))


@register("match_categories_fuzzy")
def match_categories_fuzzy(spark, root):
    m = _routed(fx.part_envelopes(spark, root))
    cands = tg.candidates(m, 2)
    c = ext.fuzzy_categories(cands, _cats(spark, fx.CATEGORY_LINES, "groups"), "groups")
    return c.select(F.col("_row").cast("long").alias("id"), "category")


@register("timespan_labels")
def timespan_labels(spark, root):
    m = fx.msg_events(spark, root)
    return m.select(
        F.col("MessageId").cast("long").alias("id"),
        *[_label(lv, "Created").alias(lv) for lv in ("alltime", "year", "month", "day", "hour")],
        _hour_ms("Created").alias("hour_ms"),
    )


@register("matches_timespan")
def matches_timespan(spark, root):
    m = ts.filter_timespan(fx.msg_lines(spark, root), "year-1997")
    return m.groupBy(_label("month", "Created").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def _source_names():
    return (F.when(F.col("doc_id") % 5 == 0, F.lit("rss")).when(F.col("doc_id") % 5 == 1, F.lit("Twitter"))
            .when(F.col("doc_id") % 5 == 2, F.lit("facebook-messages"))
            .when(F.col("doc_id") % 5 == 3, F.lit("FACEBOOK-COMMENTS")).otherwise(F.col("source")))


@register("normalize_source")
def normalize_source(spark, root):
    d = table(spark, root, "documents").select("doc_id", "source")
    return d.select("doc_id", tg.normalize_source(_source_names()).alias("code"))


@register("flatten_roundtrip")
def flatten_roundtrip(spark, root):
    u = _users_a6(spark, root)
    back = ms.unflatten_row(ms.flatten_row(u), u.schema)
    return back.select("user_id", _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"),
                       F.col("location.confidence").alias("confidence"))


@register("gazetteer_dictionary")
def gazetteer_dictionary(spark, root):
    n = table(spark, root, "nation")
    r = table(spark, root, "region")
    lines = n.select(
        F.lit("en").alias("lang"),
        F.concat_ws(",", F.col("n_name"), F.concat(F.lit(" "), (F.col("n_nationkey") * 5 - 60).cast("string")),
                    F.concat((F.col("n_nationkey") * 12 - 144).cast("string"), F.lit(" "))).alias("value"),
        F.col("n_nationkey").cast("long").alias("seq"),
    ).unionByName(r.select(
        F.lit("en").alias("lang"), F.concat_ws(",", "r_name", F.col("r_regionkey").cast("string")).alias("value"),
        (F.col("r_regionkey") + 100).cast("long").alias("seq"),
    )).unionByName(n.filter(F.col("n_regionkey") == 0).select(
        F.lit("en").alias("lang"), F.concat_ws(",", "n_name", F.lit("1.5"), F.lit("2.5")).alias("value"),
        (F.col("n_nationkey") + 200).cast("long").alias("seq"),
    ))
    return rd.load_gazetteer(lines)


def _dictionaries(spark, root) -> dict[str, DataFrame]:
    p = table(spark, root, "part")
    sheet = p.select(F.lit("en").alias("lang"), F.col("p_name").alias("term"),
                     F.concat_ws(", ", F.lower("p_type"), F.lower("p_brand")).alias("synonyms"),
                     F.upper("p_name").alias("english"), F.col("p_partkey").alias("seq"))
    return rd.build_dictionaries(sheet)


@register("build_dictionaries")
def build_dictionaries(spark, root):
    return _dictionaries(spark, root)["translations"]


@register("build_dictionaries_keywords")
def build_dictionaries_keywords(spark, root):
    return _dictionaries(spark, root)["keywords"]


@register("user_buckets")
def user_buckets(spark, root):
    e = fx.edges_orders(spark, root)
    users = e.select(F.col("src").alias("u")).unionByName(e.select(F.col("dst").alias("u"))).distinct()
    return users.groupBy(F.substring("u", 1, 2).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@register("neighbour_centroid")
def neighbour_centroid(spark, root):
    und = gr.undirected(fx.edges_orders(spark, root))
    a = fx.supplier_anchors(spark, root).select("user_id", F.col("location.lat").alias("lat"),
                                                F.col("location.lon").alias("lon"))
    return gr.neighbour_centroid(und, a)


@register("prune_newlines")
def prune_newlines(spark, root):
    from tidewatch.functions.text import prune_newlines as _prune

    d = table(spark, root, "documents", spread_small=True).select("doc_id", F.to_json(F.struct("text")).alias("raw"))
    back = d.select("doc_id", F.from_json(_prune("raw"), "text string")["text"].alias("text"))
    return back.select("doc_id", F.md5("text").alias("text_md5"))


@register("write_timeseries")
def write_timeseries(spark, root):
    docs = ts.timeseries_documents(ts.timeseries_long(fx.msg_events(spark, root)))
    path = fx.new_scratch(spark, "timeseries-docs")
    ms.write_timeseries(docs, path)
    back = spark.read.text(path)
    return back.select("name", F.md5("value").alias("doc_md5"))


def _bytes_of_two_parts(spark, src) -> int:
    """A micro-batch of two of the parts that the tasks wrote."""
    return fx.batch_bytes(spark, src, -(-max(1, fx.written_parts(spark, src)) // 2))


@register("fan_out")
def fan_out(spark, root):
    src = fx.tweet_json_dir(spark, root, fx.STREAM_LINES)
    base = fx.new_scratch(spark, "fan-out")
    stream = sp.message_stream(spark, src, S.RAW_TWEET, max_bytes_per_trigger=_bytes_of_two_parts(spark, src), consume=True)
    sp.fan_out(stream, f"{base}/table", f"{base}/graph", f"{base}/pipeline", f"{base}/ckpt")
    t = spark.read.parquet(f"{base}/table").select(F.lit("table").alias("sink"), F.col("id").cast("long").alias("id"))
    g = spark.read.json(f"{base}/graph").select(F.lit("graph").alias("sink"), F.col("id").cast("long").alias("id"))
    p = spark.read.json(f"{base}/pipeline").select(F.lit("pipeline").alias("sink"),
                                                    F.col("message.id").cast("long").alias("id"))
    return t.unionByName(g).unionByName(p).groupBy("sink").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"))


@register("archive_stream")
def archive_stream(spark, root):
    src = fx.new_scratch(spark, "archive-src")
    fx.msg_events(spark, root).select("MessageId", F.col("Created").cast("timestamp").alias("Created"),
                                      "Keywords").write.mode("overwrite").json(src)
    schema = "MessageId string, Created timestamp, Keywords array<string>"
    out, ck = fx.new_scratch(spark, "archive-out"), fx.new_scratch(spark, "archive-ckpt")
    stream = spark.readStream.schema(schema).json(src)
    sp.archive(stream, out, ck).awaitTermination()
    back = spark.read.schema(schema).json(out)
    return back.groupBy(F.col("Keywords")[0].alias("event_type")).agg(F.count(F.lit(1)).alias("n"))


@register("scan_count")
def scan_count(spark, root):
    path = fx.new_scratch(spark, "tweet-table")
    tw.write_tweets(spark, tw.tweet_row(_raw_tweets_read(spark, root)), path)
    stored = spark.read.parquet(path)
    return stored.agg(F.count(F.lit(1)).alias("n"))


@register("user_state_incremental")
def user_state_incremental(spark, root):
    src = fx.new_scratch(spark, "obs-inc")
    fx.user_obs(spark, root).repartition(4).write.mode("overwrite").parquet(src)
    out, ck = fx.new_scratch(spark, "user-inc"), fx.new_scratch(spark, "user-inc-ckpt")
    stream = sp.message_stream(spark, src, spark.read.parquet(src).schema, fmt="parquet", max_files_per_trigger=1)
    sp.run_update_to_table(sp.user_centroid_stream(stream), out, ck)
    cur = sp.latest_rows(spark.read.parquet(out), ["user_id"])
    c = gf.centre_from_vector("_cx", "_cy", "_cz")
    return cur.select("user_id", _r4(c["lat"]).alias("lat"), _r4(c["lon"]).alias("lon"),
                      F.lit(1.0).alias("confidence"))


@register("robust_centroid")
def robust_centroid(spark, root):
    c = gr.condense_locations(gr.point_observations(fx.user_obs(spark, root)))
    u = gr.robust_centroid(c, 2.0)
    return u.select("user_id", _r4(F.col("location.lat")).alias("lat"), _r4(F.col("location.lon")).alias("lon"))


@register("tag_job")
def tag_job(spark, root):
    """E2 end to end: route, tokens, keywords (region names, exact + fuzzy),
    location cascade, then the P11/P13 flags."""
    env = fx.geo_customers(spark, root)
    regions = fx.gaz_regions(spark, root).select("lang", F.col("name").alias("keyword"))
    tagged = tg.tag_messages(env, regions, None, kinds=())
    located = lc.resolve_locations(tagged, fx.gaz_world(spark, root), _users_a6(spark, root))
    return located.select(
        F.col("MessageId").cast("long").alias("id"),
        F.array_join("Keywords", ",").alias("keywords"),
        F.size("Locations").cast("long").alias("n_locations"),
        tg.has_locations("Locations").alias("has_locations"),
        tg.no_signal(located).alias("no_signal"),
    )


@register("keyword_messages")
def keyword_messages(spark, root):
    env = fx.geo_customers(spark, root)
    regions = fx.gaz_regions(spark, root).select("lang", F.col("name").alias("keyword"))
    tagged = tg.tag_messages(env, regions, None, kinds=())
    located = lc.resolve_locations(tagged, fx.gaz_world(spark, root), _users_a6(spark, root))
    rows = tg.keyword_messages(located)
    return rows.groupBy(F.col("Keyword").alias("keyword"), "Source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.size("Locations") > 0).alias("n_located"))


# ------------------------------------------- whole track list, lemmas, folder readers

@register("track_pairs")
def track_pairs(spark, root):
    """P6 with every term of the list against every document."""
    m = _routed(fx.docs_envelopes(spark, root))
    return tk.track_pairs(m, fx.track_terms(spark, root)).select(F.col("_row").cast("long").alias("doc_id"), "term")


@register("track_messages")
def track_messages(spark, root):
    """P6 over documents and part names: messages that hold any term of the list."""
    m = fx.docs_envelopes(spark, root).unionByName(fx.part_envelopes(spark, root))
    out = tk.track_messages(_routed(m), fx.track_terms(spark, root))
    return out.groupBy(F.when(F.col("Source") == "parts", "parts").otherwise("documents").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("MessageId").cast("long")).alias("sum_of_ids"))


@register("match_lemmas")
def match_lemmas(spark, root):
    """Part names and keywords that have only the lemma in common."""
    lemmas = spark.createDataFrame(fx.LEMMAS, "lang string, form string, lemma string")
    m = _routed(fx.part_envelopes(spark, root))
    pairs = lm.lemma_pairs(m, fx.keyword_dict(spark, fx.LEMMA_KEYWORDS), lemmas)
    return pairs.select(F.col("_row").cast("long").alias("id"), "term", "keyword", "lemma")


@register("read_messages")
def read_messages(spark, root):
    """S1 and S2 on files: message lines and prose in several folders, read by wildcard; good and dead rows."""
    good, bad = ms.split_bad_records(ms.read_messages(spark, fx.message_dir(spark, root)))
    rows = good.select(F.lit("ok").alias("reason"), F.coalesce(F.element_at("Keywords", 1), F.lit("")).alias("kind"),
                       F.col("MessageId").cast("long").alias("id"), F.date_trunc("second", "Created").alias("created"))
    dead = bad.select("reason", F.lit("").alias("kind"), F.lit(None).cast("long").alias("id"),
                      F.lit(None).cast("timestamp").alias("created"))
    return rows.unionByName(dead).groupBy("reason", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("sum_of_ids"),
        F.sum(F.unix_seconds(F.col("created").cast("timestamp"))).alias("sum_of_seconds"))


@register("read_refdata")
def read_refdata(spark, root):
    """S3 and S4 on files: keyword files of two languages, their lines numbered, as a dictionary."""
    lines = rd.read_refdata_lines(spark, fx.refdata_dir(spark, root), "keywords")
    sizes = lines.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lines"), F.max("seq").alias("last"),
                                      F.countDistinct("seq").alias("n_seq"))
    total = sizes.agg(F.sum("n_lines").alias("_all"), F.max("last").alias("_last"))
    checked = sizes.join(F.broadcast(total)).select("lang", "n_lines", (F.col("n_seq") == F.col("n_lines")).alias("numbered"),
                                                    (F.col("_all") == F.col("_last")).alias("gapless"))
    return rd.load_keywords(lines).join(F.broadcast(checked), "lang")


@register("fan_out_values")
def fan_out_values(spark, root):
    """What each sink holds of each message, not only how many."""
    src = fx.tweet_json_dir(spark, root, fx.STREAM_LINES)
    base = fx.new_scratch(spark, "fan-out-values")
    stream = sp.message_stream(spark, src, S.RAW_TWEET, max_bytes_per_trigger=_bytes_of_two_parts(spark, src), consume=True)
    sp.fan_out(stream, f"{base}/table", f"{base}/graph", f"{base}/pipeline", f"{base}/ckpt")
    t = spark.read.parquet(f"{base}/table").select(
        F.lit("table").alias("sink"), F.col("id").cast("long").alias("id"), F.md5("text").alias("text_md5"),
        F.col("user_id").cast("long").alias("user_id"))
    p = spark.read.json(f"{base}/pipeline").select(
        F.lit("pipeline").alias("sink"), F.col("message.id").cast("long").alias("id"),
        F.md5("message.text").alias("text_md5"), F.col("message.user_id").cast("long").alias("user_id"))
    g = spark.read.json(f"{base}/graph").select(
        F.lit("graph").alias("sink"), F.col("id").cast("long").alias("id"), F.md5("text").alias("text_md5"),
        F.col("user_id").cast("long").alias("user_id"))
    return t.unionByName(p).unionByName(g)
