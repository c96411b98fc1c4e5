from pyspark.sql import functions as F

from tidewatch.functions.text import ngrams, phrase_candidates, split_tokens
from tidewatch.operators import tagging as tg
from tidewatch.sources import refdata as rd


def test_tokens_keep_empty_and_order(spark):
    df = spark.createDataFrame([("B a,,b. c",)], "t string")
    r = df.select(split_tokens("t").alias("s")).first().s
    assert r == ["b", "a", "", "b", "", "c"]
    d = df.select(F.array_distinct(split_tokens("t")).alias("d")).first().d
    assert d == ["b", "a", "", "c"]


def test_phrase_positions(spark):
    df = spark.createDataFrame([(["hot", "gear", "x", "hot", "hot", "gear"],)], "t array<string>")
    bi = df.select(ngrams("t", 2).alias("b")).first().b
    assert bi == ["hot gear", "gear x", "x hot", "hot hot", "hot gear"]
    c = df.select(phrase_candidates("t", 2).alias("c")).first().c
    assert c.count("hot gear") == 1 and "gear" in c
    short = spark.createDataFrame([(["a"],)], "t array<string>").select(ngrams("t", 3).alias("x")).first().x
    assert short == []


def _msgs(spark, texts, lang="en"):
    rows = [(str(i), lang, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "MessageId string, Language string, Sentence string")
    df = df.withColumn("words", F.lit(None).cast("array<string>")).withColumn("tokens", F.lit(None).cast("array<string>"))
    return tg.with_tokens(df).withColumn("_row", F.col("MessageId"))


def test_keywords_exact_fuzzy_phrase_unknown_language(spark):
    kw = spark.createDataFrame([("en", "gears"), ("en", "hot gear"), ("en", "rods"), ("en", "bolt")],
                               "lang string, keyword string")
    m = _msgs(spark, ["a hot gear", "the rod", "Bolt, bolt"]).unionByName(_msgs(spark, ["gear"], lang="xx")
                                                                           .withColumn("_row", F.lit("9")))
    got = sorted((r._row, r.keyword) for r in tg.keyword_pairs(m, kw).collect())
    assert got == [("0", "gears"), ("0", "hot gear"), ("2", "bolt")]


def test_categories_last_wins_all_and_phrases(spark):
    lines = spark.createDataFrame([("en", "medical,small ring,gear", 1), ("en", "travel,gear,rod", 2)],
                                  "lang string, value string, seq long")
    cats = rd.load_categories(lines, "groups")
    m = _msgs(spark, ["small ring", "hot gear", "gear rod"])
    last = sorted((r._row, r.category) for r in tg.category_pairs(m, cats, "groups").collect())
    assert last == [("0", "medical"), ("1", "travel"), ("2", "travel")]
    allc = sorted((r._row, r.category) for r in tg.category_pairs(m, cats, "groups", on_conflict="all").collect())
    assert ("1", "medical") in allc and ("1", "travel") in allc
    every = sorted((r._row, r.category) for r in tg.category_pairs(m, cats, "groups", mode="all").collect())
    assert every == [("2", "travel")]
    nophr = sorted((r._row, r.category) for r in tg.category_pairs(m, cats, "groups", phrases=False).collect())
    assert ("0", "medical") not in nophr


def test_refdata_files(spark, tmp_path):
    (tmp_path / "groups" / "en").mkdir(parents=True)
    (tmp_path / "groups" / "en" / "g.csv").write_text("category,keywords\nHealth, Fever ,Cough\nTravel,fever\n")
    (tmp_path / "gaz" / "en").mkdir(parents=True)
    (tmp_path / "gaz" / "en" / "p.csv").write_text("Paris,48.85, 2.35\nnope,1\nRome,41.9,12.5,x\nParis,1,2\n")
    (tmp_path / "kw" / "id").mkdir(parents=True)
    (tmp_path / "kw" / "id" / "k.csv").write_text("Demam, Berdarah Dengue\n")
    g = rd.load_categories(rd.read_refdata_lines(spark, str(tmp_path), "groups"), "groups", header=True)
    res = {(r.keyword, r.category) for r in rd.resolve_categories(g).collect()}
    assert res == {("fever", "travel"), ("cough", "health")}
    gz = rd.load_gazetteer(rd.read_refdata_lines(spark, str(tmp_path), "gaz")).collect()
    assert [(r.name, r.lat, r.lon) for r in gz] == [("paris", 1.0, 2.0)]
    kw = {(r.lang, r.keyword) for r in rd.load_keywords(rd.read_refdata_lines(spark, str(tmp_path), "kw")).collect()}
    assert kw == {("id", "demam"), ("id", "berdarah dengue")}


def test_normalize_source(spark):
    df = spark.createDataFrame([("RSS",), ("facebook-comments",), ("other",), (None,)], "s string")
    assert [r.c for r in df.select(tg.normalize_source("s").alias("c")).collect()] == [0, 3, 1, 1]


def _envelope_rows(spark, rows):
    """(id, source, text, sentence, lang, geo) as envelopes."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "id string, source string, text string, sentence string, lang string, geo string")
    none = F.lit(None).cast("string")
    return df.select(
        "source", none.alias("created_at"),
        F.struct(none.alias("created_at"), "id", "geo", "lang", "source", "text", "sentence", none.alias("user_id"),
                 F.lit(None).cast("long").alias("user_followers_count"), F.lit(None).cast("long").alias("user_friends_count"),
                 none.alias("user_name")).alias("message"))


def test_tokens_come_from_the_text_on_both_routes(spark):
    from tidewatch.operators.tagging import route_source, with_tokens

    env = _envelope_rows(spark, [("1", "blog", "paris here", "hello", "en", None), ("2", "http://t", "rome", "x", "en", None)])
    got = {r.MessageId: r.tok for r in with_tokens(route_source(env)).collect()}
    assert got == {"1": ["paris", "here"], "2": ["rome"]}


def test_geojson_follows_the_routed_source(spark):
    from tidewatch.operators.tagging import route_source

    env = _envelope_rows(spark, [("1", "twitter", "a", "a", "en", "{}"), ("2", "http://t", "a", "a", "en", "{}"),
                                 ("3", "crm", "a", "a", "en", "{}"), ("4", None, "a", "a", "en", "{}")])
    assert {r.MessageId: r.is_geojson for r in route_source(env).collect()} == {"1": True, "2": True, "3": False, "4": False}


def test_repeated_phrases_count_each_time(spark):
    from tidewatch.operators.tagging import tag_messages

    env = _envelope_rows(spark, [("1", "blog", "hot gear and hot gear gear", "s", "en", None)])
    kw = spark.createDataFrame([("en", "hot gear"), ("en", "gear")], "lang string, keyword string")
    tagged = tag_messages(env, kw, None, kinds=(), fuzzy=False).first()
    assert sorted(tagged.Keywords) == ["gear", "hot gear", "hot gear"]


def test_keywords_stay_with_their_message_on_shuffled_input(spark):
    """Wide unused columns and small advisory partitions make branches of a plan coalesce differently."""
    from pyspark.sql import functions as F
    from tidewatch.operators.tagging import tag_messages

    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4kb", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
             "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(2000).select(F.col("id"), F.repeat(F.lit("wide"), 50).alias("w"))
        words = spark.range(2000).select(F.col("id"), F.concat(F.lit("word"), (F.col("id") % 7).cast("string")).alias("t"))
        j = ids.join(words, "id")
        none = F.lit(None).cast("string")
        env = j.select(F.lit("s").alias("source"), none.alias("created_at"), F.struct(
            none.alias("created_at"), F.col("id").cast("string").alias("id"), none.alias("geo"), F.lit("en").alias("lang"),
            F.lit("s").alias("source"), F.col("t").alias("text"), F.col("w").alias("sentence"), none.alias("user_id"),
            F.lit(None).cast("long").alias("user_followers_count"), F.lit(None).cast("long").alias("user_friends_count"),
            none.alias("user_name")).alias("message"))
        kw = spark.createDataFrame([("en", "word3"), ("en", "word5")], "lang string, keyword string")
        out = tag_messages(env, kw, None, kinds=(), fuzzy=False).select("MessageId", "Keywords").collect()
        assert len(out) == 2000
        for r in out:
            k = int(r.MessageId) % 7
            assert r.Keywords == ([f"word{k}"] if k in (3, 5) else [])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_content_locations_keep_token_order(spark):
    from pyspark.sql import functions as F
    from tidewatch.operators.locate import resolve_locations
    from tidewatch.operators.tagging import route_source, with_tokens

    env = _envelope_rows(spark, [("1", "crm", "zurich then athens", "s", "en", " \n\t ")])
    msgs = with_tokens(route_source(env)).withColumn("_row", F.col("MessageId"))
    gz = spark.createDataFrame([("en", "athens", 1.0, 1.0, 0), ("en", "zurich", 2.0, 2.0, 1)], "lang string, name string, lat double, lon double, seq long")
    assert [x.lat for x in resolve_locations(msgs, gz).first().Locations] == [2.0, 1.0]


def test_fuzzy_join_is_the_rule_at_all_lengths(spark):
    import random

    from tidewatch.operators.matching import fuzzy_pairs

    rng = random.Random(1)
    terms, keys = set(), set()
    for _ in range(150):
        t = "".join(rng.choice("ab") for _ in range(rng.randint(1, 30)))
        terms.add(t)
        i = rng.randrange(len(t) + 1)
        keys.add(t[:i] + rng.choice(["", "c", "ccc"]) + t[i + rng.randint(0, 2):] or "a")
    got = {(r.term, r.key) for r in fuzzy_pairs(
        spark.createDataFrame([("en", t) for t in terms], "lang string, term string"),
        spark.createDataFrame([("en", k) for k in keys], "lang string, key string")).collect()}
    from tidewatch.functions.fuzzy import _jaro_winkler

    want = set()
    for t in terms:
        for k in keys:
            m = max(len(t), len(k))
            n = -(-m * 4 // 5)
            if t != k and m >= 5 and any(k[i:i + n] in t for i in range(len(k) - n + 1)):
                want.add((t, k))
                assert _jaro_winkler(t, k) > 0.5  # so the rule needs no similarity
    assert got == want
