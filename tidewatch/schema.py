"""Logical schemas of the data model (messages, tweets, users, dictionaries)."""

from __future__ import annotations

from pyspark.sql import types as T

STR_LIST = T.ArrayType(T.StringType())

LOCATION = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("probability", T.DoubleType()),
    T.StructField("inference_type", T.StringType()),
])

# One row per message, after tagging. Created is parsed to a timestamp.
MESSAGES = T.StructType([
    T.StructField("MessageId", T.StringType()),
    T.StructField("Source", T.StringType()),
    T.StructField("Sentence", T.StringType()),
    T.StructField("Language", T.StringType()),
    T.StructField("Created", T.TimestampType()),
    T.StructField("Keywords", STR_LIST),
    T.StructField("Sectors", STR_LIST),
    T.StructField("Groups", STR_LIST),
    T.StructField("Statuses", STR_LIST),
    T.StructField("Locations", T.ArrayType(LOCATION)),
])

# Raw JSON line layout of a message: Created is still text.
MESSAGES_RAW = T.StructType([
    T.StructField("MessageId", T.StringType()),
    T.StructField("Source", T.StringType()),
    T.StructField("Sentence", T.StringType()),
    T.StructField("Language", T.StringType()),
    T.StructField("Created", T.StringType()),
    T.StructField("Keywords", STR_LIST),
    T.StructField("Sectors", STR_LIST),
    T.StructField("Groups", STR_LIST),
    T.StructField("Statuses", STR_LIST),
    T.StructField("Locations", T.ArrayType(LOCATION)),
])

# Flattened tweet (key-value table row); place and geo stay JSON text.
TWEETS = T.StructType([
    T.StructField("epoch_day", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_screen_name", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("in_reply_to", T.LongType()),
    T.StructField("place", T.StringType()),
    T.StructField("geo", T.StringType()),
])

# Raw tweet as delivered by the stream (subset of fields used).
RAW_TWEET = T.StructType([
    T.StructField("timestamp_ms", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("id_str", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("in_reply_to_user_id", T.LongType()),
    T.StructField("user", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("screen_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("followers_count", T.LongType()),
        T.StructField("friends_count", T.LongType()),
    ])),
    T.StructField("place", T.StringType()),
    T.StructField("geo", T.StringType()),
    T.StructField("limit", T.StringType()),
])

MESSAGE_ENVELOPE = T.StructType([
    T.StructField("created_at", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("geo", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("sentence", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user_followers_count", T.LongType()),
    T.StructField("user_friends_count", T.LongType()),
    T.StructField("user_name", T.StringType()),
])

ENVELOPES = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("message", MESSAGE_ENVELOPE),
    T.StructField("nlp", T.StructType([
        T.StructField("words", STR_LIST),
        T.StructField("tokens", STR_LIST),
    ])),
])

USER_LOCATION = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
])

POINT = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("location", USER_LOCATION),
    T.StructField("inferred_location", T.ArrayType(POINT)),
])

EDGES = T.StructType([
    T.StructField("src", T.StringType()),
    T.StructField("dst", T.StringType()),
])

KEYWORDS = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("keyword", T.StringType()),
])

CATEGORIES = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("seq", T.LongType()),
])

GAZETTEER = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("seq", T.LongType()),
])

TIMESERIES_LONG = T.StructType([
    T.StructField("timespan", T.StringType()),
    T.StructField("hour_ms", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("label", T.StringType()),
    T.StructField("n", T.LongType()),
])
