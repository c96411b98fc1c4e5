"""Message-shaped inputs derived from the given tables (see FIXTURES.md).

Each builder is a plain projection/join over a whole table, so its cost grows
with the data; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.common import FAST_GZIP
from tidewatch.sources.tables import table

def EMPTY():
    return F.array().cast("array<string>")


def NO_LOCATIONS():
    return F.array().cast("array<struct<lat:double,lon:double,probability:double,inference_type:string>>")


def events_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def msg_events(spark: SparkSession, root: str) -> DataFrame:
    """Messages from ``events``: one keyword, group k%7, status high/low."""
    ev = events_k(table(spark, root, "events", spread_small=True))
    return ev.select(
        F.col("event_id").cast("string").alias("MessageId"),
        F.lit("events").alias("Source"),
        F.lit(None).cast("string").alias("Sentence"),
        F.lit("en").alias("Language"),
        F.col("ts").alias("Created"),
        F.array("event_type").alias("Keywords"),
        EMPTY().alias("Sectors"),
        F.array(F.concat(F.lit("k"), (F.col("k") % 7).cast("string"))).alias("Groups"),
        F.array(F.when(F.col("value") >= 100, "high").otherwise("low")).alias("Statuses"),
        NO_LOCATIONS().alias("Locations"),
    )


def msg_lines(spark: SparkSession, root: str, repeat_keywords: bool = False) -> DataFrame:
    """Messages from ``lineitem ⋈ part``; several values per list, seven years.

    Part is the dimension side of a foreign-key join; the planner chooses the
    strategy from its measured size (AQE), nothing is forced here.
    """
    li = table(spark, root, "lineitem", spread_small=True).select("l_partkey", "l_shipdate", "l_returnflag")
    part = table(spark, root, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    name = F.concat_ws(" ", "p_name", "p_name") if repeat_keywords else F.col("p_name")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.lit(None).cast("string").alias("MessageId"),
        F.lit("lines").alias("Source"),
        F.col("p_name").alias("Sentence"),
        F.lit("en").alias("Language"),
        F.col("l_shipdate").alias("Created"),
        F.split(name, " ").alias("Keywords"),
        F.array("p_type").alias("Sectors"),
        F.array("p_brand").alias("Groups"),
        F.array("l_returnflag").alias("Statuses"),
        NO_LOCATIONS().alias("Locations"),
    )


def msg_repeats(spark: SparkSession, root: str) -> DataFrame:
    """``msg_lines`` with every keyword twice (occurrences vs records)."""
    return msg_lines(spark, root, repeat_keywords=True)


# ------------------------------------------------------------------ tagging

def docs_envelopes(spark: SparkSession, root: str) -> DataFrame:
    """``documents`` as pipeline envelopes without NLP output (NLP branch)."""
    d = table(spark, root, "documents", spread_small=True)
    return d.select(
        F.col("source"),
        F.lit(None).cast("string").alias("created_at"),
        F.struct(
            F.lit(None).cast("string").alias("created_at"),
            F.col("doc_id").cast("string").alias("id"),
            F.lit(None).cast("string").alias("geo"),
            F.col("lang").alias("lang"),
            F.col("source").alias("source"),
            F.col("text").alias("text"),
            F.col("text").alias("sentence"),
            F.lit(None).cast("string").alias("user_id"),
            F.lit(None).cast("long").alias("user_followers_count"),
            F.lit(None).cast("long").alias("user_friends_count"),
            F.lit(None).cast("string").alias("user_name"),
        ).alias("message"),
    )


def mixed_envelopes(spark: SparkSession, root: str) -> DataFrame:
    """``documents`` over both routes: odd ids arrive as tweets (http source;
    their Spanish rows carry the language code "in" to exercise P8). The NLP
    branch reads ``sentence`` (the text with a "nlp: " prefix), tweets read ``text``."""
    d = table(spark, root, "documents", spread_small=True)
    tweet = (F.col("doc_id") % 2) == 1
    return d.select(
        F.col("source"),
        F.lit(None).cast("string").alias("created_at"),
        F.struct(
            F.lit(None).cast("string").alias("created_at"),
            F.col("doc_id").cast("string").alias("id"),
            F.lit(None).cast("string").alias("geo"),
            F.when(tweet & (F.col("lang") == "es"), F.lit("in")).otherwise(F.col("lang")).alias("lang"),
            F.when(tweet, F.concat(F.lit("http://t/"), F.col("source"))).otherwise(F.col("source")).alias("source"),
            F.col("text").alias("text"),
            F.concat(F.lit("nlp: "), F.col("text")).alias("sentence"),
            F.lit(None).cast("string").alias("user_id"),
            F.lit(None).cast("long").alias("user_followers_count"),
            F.lit(None).cast("long").alias("user_friends_count"),
            F.lit(None).cast("string").alias("user_name"),
        ).alias("message"),
    )


def part_envelopes(spark: SparkSession, root: str) -> DataFrame:
    """``part`` names as English messages (NLP branch)."""
    p = table(spark, root, "part")
    return p.select(
        F.lit("parts").alias("source"),
        F.lit(None).cast("string").alias("created_at"),
        F.struct(
            F.lit(None).cast("string").alias("created_at"),
            F.col("p_partkey").cast("string").alias("id"),
            F.lit(None).cast("string").alias("geo"),
            F.lit("en").alias("lang"),
            F.lit("parts").alias("source"),
            F.col("p_name").alias("text"),
            F.col("p_name").alias("sentence"),
            F.lit(None).cast("string").alias("user_id"),
            F.lit(None).cast("long").alias("user_followers_count"),
            F.lit(None).cast("long").alias("user_friends_count"),
            F.lit(None).cast("string").alias("user_name"),
        ).alias("message"),
    )


def line_envelopes(spark: SparkSession, root: str) -> DataFrame:
    """``lineitem ⋈ part`` as English messages without an id: the order line's
    part name. The join is a shuffle join (merge hint), so the messages come
    from a shuffle, and wide columns are carried along."""
    li = table(spark, root, "lineitem", spread_small=True)
    p = table(spark, root, "part").select("p_partkey", "p_name")
    j = li.hint("merge").join(p, li.l_partkey == p.p_partkey)
    none = F.lit(None).cast("string")
    return j.select(
        F.lit("lines").alias("source"),
        none.alias("created_at"),
        F.struct(
            none.alias("created_at"), none.alias("id"), none.alias("geo"), F.lit("en").alias("lang"),
            F.lit("lines").alias("source"), F.col("p_name").alias("text"), F.col("p_name").alias("sentence"),
            none.alias("user_id"), F.lit(None).cast("long").alias("user_followers_count"),
            F.lit(None).cast("long").alias("user_friends_count"), F.col("l_comment" if "l_comment" in j.columns else "l_shipmode" if "l_shipmode" in j.columns else "p_name").alias("user_name"),
        ).alias("message"),
    )


# Test dictionaries of FIXTURES.md (reference data, not messages).
PART_KEYWORDS = ["widgets", "anvils", "gizmos", "plates", "gears", "rods", "small ring", "hot gear", "bolt"]
DOC_TERMS = ["thatin", "ononst", "inoran", "hehely", "orantion", "thble", "thing", "nicht"]
CATEGORY_LINES = ["medical,small ring,gear", "travel,gear,rod"]
CATEGORY_ALL_LINES = ["smallring,small,ring", "hotgear,hot,gear", "redwidget,red,widget"]


# Forms with their lemma, and keywords that share only a lemma with the part names' words.
LEMMAS = [("en", "cog", "gear"), ("en", "sprocket", "gear"), ("en", "smallest", "small"), ("en", "tiny", "small"),
          ("en", "scarlet", "red"), ("en", "doohickeys", "gizmo")]
LEMMA_KEYWORDS = ["cogs", "sprockets", "smallest", "scarlet", "doohickeys", "widgeting", "tiny cog", "platings"]


def keyword_dict(spark: SparkSession, terms: list[str], lang: str = "en") -> DataFrame:
    return spark.createDataFrame([(lang, t) for t in terms], "lang string, keyword string")


def part_keywords(spark: SparkSession) -> DataFrame:
    return keyword_dict(spark, PART_KEYWORDS)


def doc_keywords(spark: SparkSession) -> DataFrame:
    """Document terms plus a one-letter variant of each (first letter dropped),
    for every document language."""
    rows = []
    for lang in ("en", "fr", "de", "es"):
        for t in DOC_TERMS:
            rows += [(lang, t), (lang, t[1:])]
    return spark.createDataFrame(rows, "lang string, keyword string")


def category_lines(spark: SparkSession, lines: list[str] = CATEGORY_LINES, lang: str = "en") -> DataFrame:
    return spark.createDataFrame([(lang, v, i + 1) for i, v in enumerate(lines)], "lang string, value string, seq long")


# ---------------------------------------------------------------------- geo

def gaz_regions(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "region")
    return r.select(
        F.lit("en").alias("lang"), F.lower("r_name").alias("name"),
        (F.col("r_regionkey") * 10 - 20).cast("double").alias("lat"),
        (F.col("r_regionkey") * 30 - 60).cast("double").alias("lon"),
        F.col("r_regionkey").cast("long").alias("seq"),
    )


def gaz_nations(spark: SparkSession, root: str, seq_offset: int = 0) -> DataFrame:
    n = table(spark, root, "nation")
    return n.select(
        F.lit("en").alias("lang"), F.lower("n_name").alias("name"),
        (F.col("n_nationkey") * 5 - 60).cast("double").alias("lat"),
        (F.col("n_nationkey") * 12 - 144).cast("double").alias("lon"),
        (F.col("n_nationkey") + seq_offset).cast("long").alias("seq"),
    )


def gaz_world(spark: SparkSession, root: str) -> DataFrame:
    """Regions first (seq 0-4), then nations (seq 100+)."""
    return gaz_regions(spark, root).unionByName(gaz_nations(spark, root, 100))


def geo_customers(spark: SparkSession, root: str) -> DataFrame:
    """``customer ⋈ nation ⋈ region`` as envelopes with three geo cases.

    c_custkey % 3 = 0: tweet with a ``geo`` point in lat,lon order (every
    third of those ``{}``, every third after that unparsable); 1: tweet with a
    blank geo; 2: NLP message whose geo is the region name as typed by the user
    (odd keys with a trailing "s"). Text = name, nation, region.
    """
    c = table(spark, root, "customer", spread_small=True).select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, root, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, root, "region").select("r_regionkey", "r_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    kind = F.col("c_custkey") % 3
    point = F.format_string(
        '{"type":"Point","coordinates":[%s,%s]}',
        (F.col("n_nationkey") * 5 - 60).cast("double"), (F.col("n_nationkey") * 12 - 144).cast("double"),
    )
    geo = (
        F.when((kind == 0) & (F.col("c_custkey") % 9 == 3), F.lit("{}"))
        .when((kind == 0) & (F.col("c_custkey") % 9 == 6), F.lit("not json"))
        .when(kind == 0, point)
        .when(kind == 1, F.lit(""))
        .otherwise(F.concat(F.lower("r_name"), F.when(F.col("c_custkey") % 2 == 1, F.lit("s")).otherwise(F.lit(""))))
    )
    text = F.concat_ws(" ", "c_name", "n_name", "r_name")
    src = F.when(kind == 2, F.lit("crm")).otherwise(F.lit("http://twitter.com"))
    return j.select(
        src.alias("source"),
        F.lit(None).cast("string").alias("created_at"),
        F.struct(
            F.lit(None).cast("string").alias("created_at"),
            F.col("c_custkey").cast("string").alias("id"),
            geo.alias("geo"),
            F.lit("en").alias("lang"),
            src.alias("source"),
            text.alias("text"),
            text.alias("sentence"),
            F.col("c_custkey").cast("string").alias("user_id"),
            F.lit(None).cast("long").alias("user_followers_count"),
            F.lit(None).cast("long").alias("user_friends_count"),
            F.col("c_name").alias("user_name"),
        ).alias("message"),
    )


def place_json(spark: SparkSession, root: str) -> DataFrame:
    """(c_custkey, place): a box of half-width 1 + key % 5 degrees around the
    customer's nation point; every 7th key is a non-polygon place."""
    c = table(spark, root, "customer", spread_small=True).select("c_custkey", "c_nationkey")
    lat = (F.col("c_nationkey") * 5 - 60).cast("double")
    lon = (F.col("c_nationkey") * 12 - 144).cast("double")
    d = (F.col("c_custkey") % 5 + 1).cast("double")
    ptype = F.when(F.col("c_custkey") % 7 == 0, F.lit("Point")).otherwise(F.lit("Polygon"))
    js = F.format_string(
        '{"id":"p%s","bounding_box":{"type":"%s","coordinates":[[[%s,%s],[%s,%s],[%s,%s],[%s,%s]]]}}',
        F.col("c_nationkey"), ptype, lon - d, lat - d, lon + d, lat - d, lon + d, lat + d, lon - d, lat + d,
    )
    return c.select("c_custkey", js.alias("place"))


def user_obs(spark: SparkSession, root: str) -> DataFrame:
    """(user_id, lat, lon) observations from ``events`` (repeat points kept)."""
    ev = events_k(table(spark, root, "events", spread_small=True))
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        (F.col("k") - 50).cast("double").alias("lat"),
        ((F.col("k") * 3) % 360 - 180).cast("double").alias("lon"),
    )


# -------------------------------------------------------------------- graph

def edges_orders(spark: SparkSession, root: str) -> DataFrame:
    """Directed edges customer → order (``orders``) and order → supplier (``lineitem``)."""
    o = table(spark, root, "orders", spread_small=True).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("dst"),
    )
    li = table(spark, root, "lineitem", spread_small=True).select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("src"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst"),
    )
    return o.unionByName(li)


def supplier_anchors(spark: SparkSession, root: str) -> DataFrame:
    """Suppliers located at their nation's gazetteer point, confidence 1."""
    s = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    return s.select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("user_id"),
        F.struct(
            (F.col("s_nationkey") * 5 - 60).cast("double").alias("lat"),
            (F.col("s_nationkey") * 12 - 144).cast("double").alias("lon"),
            F.lit(1.0).alias("confidence"),
        ).alias("location"),
    )


# ---------------------------------------------------------------- ingest

def new_scratch(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared checkpoint root for one run."""
    import uuid

    from tidewatch.session import scratch_dir

    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def raw_tweets(spark: SparkSession, root: str) -> DataFrame:
    """All ``events`` as raw stream records, each with the text of document
    event_id modulo the number of documents.

    Error events arrive as rate-limit notices; clicks reply to another user;
    views carry a ``geo`` point (lat,lon); Spanish is tagged "in".
    """
    d = table(spark, root, "documents", spread_small=True).select("doc_id", "text", "lang")
    ev = events_k(table(spark, root, "events", spread_small=True))
    n_docs = max(1, d.count())
    j = ev.join(d, F.pmod(ev.event_id, F.lit(n_docs)) == d.doc_id, "left")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    tweet = F.to_json(F.struct(
        ms.cast("string").alias("timestamp_ms"),
        F.col("event_id").alias("id"),
        F.col("event_id").cast("string").alias("id_str"),
        F.date_format(F.col("ts"), "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
        F.lit("http://twitter.com").alias("source"),
        F.col("text"),
        F.when(F.col("lang") == "es", F.lit("in")).otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("event_type") == "click", (F.col("user_id") * 7) % 150).alias("in_reply_to_user_id"),
        F.struct(
            F.col("user_id").alias("id"),
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("screen_name"),
            F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("name"),
            F.col("k").cast("long").alias("followers_count"),
            (F.col("k") * 2).cast("long").alias("friends_count"),
        ).alias("user"),
        F.when(
            F.col("event_type") == "view",
            F.concat(F.lit('{"type":"Point","coordinates":['), (F.col("k") - 50).cast("string"), F.lit(","),
                     ((F.col("k") * 3) % 360 - 180).cast("string"), F.lit("]}")),
        ).alias("geo"),
    ))
    notice = F.to_json(F.struct(F.struct(F.col("event_id").alias("track")).alias("limit")))
    return j.select(F.when(F.col("event_type") == "error", notice).otherwise(tweet).alias("value"))


#: Row groups of a file that is one micro-batch: a row group is read by one task.
ROW_GROUP_BYTES = 4 << 20
#: Lines of a packed file: gzip files are read by one task each.
PACKED_LINES = 100_000
#: The same where the folder feeds a stream: a micro-batch is a share of it, which many tasks shall read.
STREAM_LINES = 20_000


def packed_lines(spark: SparkSession, lines: DataFrame, name: str, most: int = PACKED_LINES) -> str:
    """Write lines into a fresh scratch folder as the tasks give them (no shuffle), in gzip files of at most ``most`` lines."""
    path = new_scratch(spark, name)
    lines.write.options(**FAST_GZIP).option("maxRecordsPerFile", most).text(path)
    return path


def tweet_json_dir(spark: SparkSession, root: str, most: int = PACKED_LINES) -> str:
    """The raw tweets as JSON lines in packed files."""
    return packed_lines(spark, raw_tweets(spark, root), "tweets-json", most)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(name, length) of the files of a written folder."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def total_bytes(spark: SparkSession, path: str) -> int:
    return file_sizes(spark, path).agg(F.sum("length")).first()[0] or 0


def batch_bytes(spark: SparkSession, path: str, batches: int, but: int = 0) -> int:
    """Bytes of a micro-batch that reads the folder, but for its ``but`` bytes read before, in ``batches`` of them: half
    a file more than a share, so that files of one size come out even; uneven ones may leave a rest for another batch."""
    r = file_sizes(spark, path).agg(F.sum("length").alias("all"), F.max("length").alias("most")).first()
    return -(-max(0, (r["all"] or 0) - but) // batches) + (r["most"] or 0) // 2 + 1


def written_parts(spark: SparkSession, path: str) -> int:
    """Number of the tasks that wrote a folder (``part-N-...``, each in one or more files)."""
    return file_sizes(spark, path).agg(F.countDistinct(F.split("name", "-")[1])).first()[0]


def tweet_lines(spark: SparkSession, root: str) -> DataFrame:
    """Raw tweets of all ``events`` among bad lines: every line of every
    ``documents`` text (prose), a tweet cut off in its middle for each event with
    k % 5 = 0, one without an id for k % 5 = 1, without a time for k % 5 = 2,
    without a user for k % 5 = 3, and a blank line for k % 5 = 4."""
    k = F.col("k") % 5
    eid = F.col("event_id").cast("string")
    bad = (
        F.when(k == 0, F.concat(F.lit('{"id":'), eid, F.lit(',"timestamp_ms":"0","text":"cut')))
        .when(k == 1, F.concat(F.lit('{"timestamp_ms":"'), eid, F.lit('","user":{"id":1}}')))
        .when(k == 2, F.concat(F.lit('{"id":'), eid, F.lit(',"timestamp_ms":"soon","user":{"id":1}}')))
        .when(k == 3, F.concat(F.lit('{"id":'), eid, F.lit(',"timestamp_ms":"5"}')))
        .otherwise(F.lit(" "))
    )
    ev = events_k(table(spark, root, "events", spread_small=True))
    docs = table(spark, root, "documents", spread_small=True).select(F.explode(F.split("text", "\n", -1)).alias("value"))
    return raw_tweets(spark, root).unionByName(ev.select(bad.alias("value"))).unionByName(docs)


def envelope_lines(spark: SparkSession, root: str) -> DataFrame:
    """``part`` names as message lines in English, every 3rd in a language that
    gets a dictionary later ("fr"), every 7th in one that never does ("xx"),
    every 11th cut off."""
    p = table(spark, root, "part")
    key = F.col("p_partkey")
    lang = F.when(key % 7 == 0, "xx").when(key % 3 == 0, "fr").otherwise("en")
    line = F.concat(F.lit('{"message":{"id":"'), key.cast("string"), F.lit('","lang":"'), lang,
                    F.lit('","source":"parts","text":"'), F.col("p_name"), F.lit('","sentence":"'), F.col("p_name"), F.lit('"'))
    return p.select(F.when(key % 11 == 0, line).otherwise(F.concat(line, F.lit("}}"))).alias("value"))


def message_lines(spark: SparkSession, root: str) -> DataFrame:
    """Raw message lines: ``events`` as JSON messages (clicks with the stream's
    date layout, errors with an unparsable date, purchases without one) plus
    every line of every ``documents`` text (prose, so mostly malformed)."""
    ev = events_k(table(spark, root, "events", spread_small=True))
    created = (
        F.when(F.col("event_type") == "click", F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy"))
        .when(F.col("event_type") == "error", F.date_format("ts", "dd/MM/yyyy HH:mm"))
        .when(F.col("event_type") == "purchase", F.lit(None).cast("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    msgs = ev.select(F.to_json(F.struct(
        F.col("event_id").cast("string").alias("MessageId"),
        created.alias("Created"),
        F.array("event_type").alias("Keywords"),
    )).alias("value"))
    docs = table(spark, root, "documents", spread_small=True).select(F.explode(F.split("text", "\n", -1)).alias("value"))
    return msgs.unionByName(docs)


def track_terms(spark: SparkSession, root: str) -> DataFrame:
    """Every term of the uncapped track list over the parts, and the document terms."""
    from tidewatch.sources.refdata import track_list

    p = table(spark, root, "part")
    lines = p.select(F.concat_ws(",", "p_name", "p_type").alias("value"), F.col("p_partkey").alias("seq"))
    docs = spark.createDataFrame([(t,) for t in DOC_TERMS], "term string")
    return track_list(lines).select("term").unionByName(docs)


def message_dir(spark: SparkSession, root: str) -> str:
    """``message_lines`` as text files in several folders; returns their wildcard path."""
    base = new_scratch(spark, "messages")
    message_lines(spark, root).withColumn("folder", F.pmod(F.xxhash64("value"), F.lit(3))).write.partitionBy(
        "folder").text(base)
    return f"{base}/*/*"


def refdata_dir(spark: SparkSession, root: str) -> str:
    """Keyword files of two languages written from tables: part names and types
    (en), names of nations with their region's key (fr), and a folder one level
    deeper that must not be read."""
    base = new_scratch(spark, "refdata")
    parts = table(spark, root, "part").select(F.concat_ws(" , ", F.upper("p_name"), "p_type").alias("value"))
    nations = table(spark, root, "nation").select(F.concat_ws(",", "n_name", F.col("n_regionkey").cast("string")).alias("value"))
    parts.repartition(3).write.text(f"{base}/keywords/en")
    nations.repartition(2).write.text(f"{base}/keywords/fr")
    nations.write.text(f"{base}/keywords/fr/more")
    return base


def msg_events_located(spark: SparkSession, root: str) -> DataFrame:
    """``msg_events`` with the event's point as its one location."""
    ev = events_k(table(spark, root, "events", spread_small=True))
    m = msg_events(spark, root)
    loc = F.array(F.struct(
        (F.col("k") - 50).cast("double").alias("lat"), ((F.col("k") * 3) % 360 - 180).cast("double").alias("lon"),
        F.lit(1.0).alias("probability"), F.lit("Tagged").alias("inference_type")))
    pts = ev.select(F.col("event_id").cast("string").alias("MessageId"), loc.alias("_loc"))
    return m.drop("Locations").join(pts, "MessageId").withColumnRenamed("_loc", "Locations")


def doc_translations(spark: SparkSession) -> DataFrame:
    """X3 reference data: each one-letter variant of a document term → the term."""
    rows = [(lang, t[1:], t) for lang in ("en", "fr", "de", "es") for t in DOC_TERMS]
    return spark.createDataFrame(rows, "lang string, term string, canonical string")
