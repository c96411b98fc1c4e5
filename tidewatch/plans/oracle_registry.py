"""name -> DuckDB SQL, paired with ``tidewatch.plans.catalog.REGISTRY``."""

from __future__ import annotations

from tidewatch.plans import oracle as o

ORACLE: dict[str, str] = {}

ORACLE["timeseries_long"] = o.trend_sql("events", o.TIMESERIES_LONG_BODY)
for _fix in ("events", "lines", "repeats"):
    ORACLE[f"timeseries_long_{_fix}"] = o.trend_sql(_fix, o.TIMESERIES_LONG_BODY)

ORACLE["section_counts"] = o.trend_sql("lines", o.SECTION_COUNTS_BODY)
ORACLE["section_counts_repeats"] = o.trend_sql("repeats", o.SECTION_COUNTS_BODY)
ORACLE["distinct_timespans"] = o.trend_sql("lines", o.DISTINCT_SPANS_BODY)
ORACLE["topk_per_timespan"] = o.trend_sql("lines", o.TOPK_BODY)
ORACLE["topk_per_timespan_events"] = o.trend_sql("events", o.TOPK_BODY)
ORACLE["hourly_counts"] = o.trend_sql("events", o.HOURLY_BODY)
ORACLE["timeseries_documents"] = o.trend_sql("events", o.DOCUMENTS_BODY)
ORACLE["timeseries_documents_lines"] = o.trend_sql("lines", o.DOCUMENTS_BODY)

# ---- tagging
from tidewatch.plans import fixtures as _fx  # noqa: E402

_PART_KW = [("en", k) for k in _fx.PART_KEYWORDS]
_DOC_KW = [(lang, t) for lang in ("en", "fr", "de", "es") for term in _fx.DOC_TERMS for t in (term, term[1:])]

ORACLE["tokens"] = o.TOKENS
ORACLE["ngrams"] = o.NGRAMS
ORACLE["match_keywords_exact"] = o.keyword_match_sql(o.PART_TOK, "pm", _PART_KW, fuzzy=False)
ORACLE["match_keywords_fuzzy"] = o.keyword_match_sql(o.PART_TOK, "pm", _PART_KW, fuzzy=True)
ORACLE["match_phrases"] = o.keyword_match_sql(o.PART_TOK, "pm", _PART_KW, fuzzy=True, where="AND contains(kw.keyword, ' ')")
ORACLE["match_keywords_docs"] = o.keyword_match_sql(o.DOC_TOK, "dm", _DOC_KW, fuzzy=True)
ORACLE["lcs_length"] = o.doc_pairs_sql(_DOC_KW) + o.LCS_BODY
ORACLE["fuzzy_pairs_docs"] = o.fuzzy_pairs_docs_sql(_DOC_KW)
ORACLE["match_groups_any"] = o.category_match_sql(_fx.CATEGORY_LINES)
ORACLE["match_groups_all"] = o.category_match_sql(_fx.CATEGORY_ALL_LINES, mode="all")
ORACLE["match_sectors"] = o.category_match_sql(_fx.CATEGORY_LINES, on_conflict="all")
ORACLE["match_statuses"] = o.category_match_sql(_fx.CATEGORY_LINES, phrases=False)
ORACLE["route_source"] = o.ROUTE_SOURCE
ORACLE["keyword_dictionary"] = o.KEYWORD_DICTIONARY
ORACLE["category_dictionary"] = o.CATEGORY_DICTIONARY
ORACLE["track_list"] = o.TRACK_LIST
ORACLE["track_list_uncapped"] = o.TRACK_LIST_UNCAPPED
ORACLE["track_list_dropped"] = o.TRACK_LIST_DROPPED
ORACLE["tokens_mixed"] = o.TOKENS_MIXED
ORACLE["tag_shuffled"] = o.tag_shuffled_sql(_PART_KW)
ORACLE["replay_columns"] = o.TWEET_ROW
ORACLE["jaro_winkler"] = o.doc_pairs_sql(_DOC_KW) + o.JW_BODY

# ---- geo and graph
ORACLE["bbox_center"] = o.BBOX_CENTER
ORACLE["geo_center"] = o.GEO_CENTER
ORACLE["geo_points"] = o.GEO_POINTS
ORACLE["locate_by_content"] = o.content_sql(False)
ORACLE["locate_by_content_exact_first"] = o.content_sql(True)
ORACLE["locate_by_user_text"] = o.USER_TEXT
ORACLE["user_location_join"] = o.USER_JOIN
ORACLE["resolve_locations"] = o.RESOLVE
ORACLE["track_filter"] = o.TRACK_FILTER
ORACLE["condense_locations"] = o.CONDENSE
ORACLE["user_centroid"] = o.USER_CENTROID
ORACLE["reply_edges"] = o.REPLY_EDGES
ORACLE["adjacency"] = o.ADJACENCY
ORACLE["propagate_1"] = o.propagate_sql(1, o.PROPAGATE_BODY)
ORACLE["propagate_5"] = o.propagate_sql(5, o.PROPAGATE_BODY)
ORACLE["propagation_metrics"] = o.propagate_sql(5, o.metrics_body(5))
ORACLE["merge_users"] = o.MERGE_USERS

# ---- ingest and streams
ORACLE["tweet_row"] = o.TWEET_ROW
ORACLE["tweet_envelope"] = o.TWEET_ENVELOPE
ORACLE["dedup_insert"] = o.DEDUP_INSERT
# replay: JSON text of whole rows (Spark's to_json layout); replay_columns checks its values.
ORACLE["bad_records"] = o.BAD_RECORDS
ORACLE["hourly_stream"] = o.trend_sql("events", o.HOURLY_STREAM_BODY)
ORACLE["late_events"] = o.LATE_EVENTS
ORACLE["adjacency_lists"] = o.ADJACENCY_LISTS
ORACLE["place_observations"] = o.PLACE_OBSERVATIONS
ORACLE["user_state"] = o.USER_STATE
ORACLE["stream_tagging_located"] = o.keyword_messages_sql()
ORACLE["stream_tagging"] = ORACLE["match_keywords_fuzzy"]
ORACLE["fan_out_dead_letters"] = o.FAN_OUT_DEAD_LETTERS
ORACLE["tag_dead_letters"] = o.tag_dead_letters_sql(ORACLE["match_keywords_fuzzy"])
ORACLE["late_archives"] = o.LATE_ARCHIVES
ORACLE["user_state_live"] = o.USER_STATE
ORACLE["merge_table"] = ORACLE["merge_users"]
ORACLE["user_state_stream"] = o.USER_CENTROID

# ---- extensions and remaining operators
_TR = [(lang, t[1:], t) for lang in ("en", "fr", "de", "es") for t in _fx.DOC_TERMS]
ORACLE["tile_timeseries"] = o.TILE_TIMESERIES
ORACLE["category_confidence"] = o.category_confidence_sql(_fx.CATEGORY_ALL_LINES)
ORACLE["translated_terms"] = o.translated_sql(_DOC_KW, _TR)
ORACLE["weighted_centroid"] = o.WEIGHTED_CENTROID
ORACLE["match_categories_fuzzy"] = o.fuzzy_categories_sql(_fx.CATEGORY_LINES)
ORACLE["timespan_labels"] = o.TIMESPAN_LABELS
ORACLE["matches_timespan"] = o.MATCHES_TIMESPAN
ORACLE["normalize_source"] = o.NORMALIZE_SOURCE
ORACLE["flatten_roundtrip"] = o.USER_CENTROID
ORACLE["gazetteer_dictionary"] = o.GAZETTEER_DICTIONARY
ORACLE["build_dictionaries"] = o.BUILD_DICTIONARIES
ORACLE["build_dictionaries_keywords"] = o.BUILD_DICTIONARIES_KEYWORDS
ORACLE["user_buckets"] = o.USER_BUCKETS
ORACLE["neighbour_centroid"] = o.propagate_sql(1, "SELECT user_id, lat, lon FROM cen1 WHERE lat IS NOT NULL")
ORACLE["prune_newlines"] = o.PRUNE_NEWLINES
ORACLE["write_timeseries"] = o.write_timeseries_sql()
ORACLE["timeseries_live"] = ORACLE["write_timeseries"]
ORACLE["emit_sentence"] = o.emit_sentence_sql(_PART_KW, _fx.CATEGORY_LINES)
ORACLE["fan_out"] = """WITH """ + o.TWEETS_J.strip() + """,
t AS (SELECT event_id FROM j WHERE event_type <> 'error')
SELECT sink, count(*) AS n, count(DISTINCT event_id) AS n_ids
FROM (SELECT 'table' AS sink, event_id FROM t UNION ALL SELECT 'graph', event_id FROM t
      UNION ALL SELECT 'pipeline', event_id FROM t) GROUP BY sink"""
ORACLE["archive_stream"] = o.LATE_EVENTS
ORACLE["scan_count"] = "WITH " + o.TWEETS_J.strip() + "\nSELECT count(*) AS n FROM j WHERE event_type <> 'error'"
ORACLE["user_state_incremental"] = o.USER_CENTROID
ORACLE["robust_centroid"] = o.ROBUST_CENTROID
ORACLE["tag_job"] = o.tag_job_sql()
ORACLE["keyword_messages"] = o.keyword_messages_sql()

# ---- whole track list, lemmas, folder readers
ORACLE["track_pairs"] = o.track_sql(_fx.DOC_TERMS, o.TRACK_PAIRS_BODY)
ORACLE["track_messages"] = o.track_sql(_fx.DOC_TERMS, o.TRACK_MESSAGES_BODY)
ORACLE["match_lemmas"] = o.lemma_sql(_fx.LEMMAS, _fx.LEMMA_KEYWORDS)
ORACLE["read_messages"] = o.READ_MESSAGES
ORACLE["read_refdata"] = o.READ_REFDATA
ORACLE["fan_out_values"] = o.FAN_OUT_VALUES
