import os

from pyspark.sql import functions as F

from tidewatch.operators import lemmas as lm
from tidewatch.operators import locate as lc
from tidewatch.operators import track as tk
from tidewatch.operators.matching import match_terms
from tidewatch.sources import refdata as rd

TEXTS = [("0", "The Flood hit Koña"), ("1", None), ("2", ""), ("3", "flooding, heavy rain and flood"), ("4", "dry"),
         ("5", "x" * 300_000 + "heavy rain" + "y" * 300_000), ("5", "rain")]
TERMS = ["flood", "FLOOD", "heavy rain", "rain", "koña", "", "  ", None, "absent"]


def _msgs(spark):
    return spark.createDataFrame([(k, t, "kept") for k, t in TEXTS], "_row string, Sentence string, term string")


def _terms(spark, terms=TERMS):
    return spark.createDataFrame([(t,) for t in terms], "term string")


def _brute(texts, terms):
    wanted = {t.lower() for t in terms if t and t.strip()}
    return sorted((k, t) for k, text in texts if text for t in wanted if t in text.lower())


def test_track_pairs_equal_plain_containment_in_one_block_and_in_many(spark):
    want = _brute(TEXTS, TERMS)
    for max_bytes in (tk.MAX_BYTES, 80):
        got = tk.track_pairs(_msgs(spark), _terms(spark), max_bytes=max_bytes)
        assert sorted((r._row, r.term) for r in got.collect()) == want


def test_track_messages_keeps_rows_as_they_are_once(spark):
    want = sorted((k, t) for k, t in TEXTS if t and _brute([(k, t)], TERMS))
    for max_bytes in (tk.MAX_BYTES, 80):
        got = tk.track_messages(_msgs(spark), _terms(spark), max_bytes=max_bytes)
        assert got.columns == ["_row", "Sentence", "term"]
        assert sorted((r._row, r.Sentence) for r in got.collect()) == want


def test_track_without_terms_or_messages(spark):
    none = _terms(spark, [None, " "])
    assert tk.track_pairs(_msgs(spark), none).collect() == []
    assert tk.track_messages(_msgs(spark), none).collect() == []
    assert tk.track_pairs(_msgs(spark).limit(0), _terms(spark)).collect() == []


def test_track_agrees_with_the_literal_filter(spark):
    terms = ["flood", "koña"]
    a = lc.track_filter(_msgs(spark).filter("Sentence is not null"), terms=terms).count()
    assert tk.track_messages(_msgs(spark), _terms(spark, terms)).count() == a


def test_lemmas_table_first_then_rule_then_the_word(spark):
    lemmas = spark.createDataFrame([("en", "went", "go"), ("en", "Mouse", "mouse"), ("en", "leaf", "leaf"),
                                    ("en", "was", "be"), ("en", "was", "am")], "lang string, form string, lemma string")
    words = spark.createDataFrame([("en", w, 1) for w in ("went", "cities", "floods", "is", "was", "", "classes")]
                                  + [("xx", "floods", 1), (None, "floods", 1), ("en", None, 1)],
                                  "lang string, term string, extra int")
    got = {(r.lang, r.term): r.lemma for r in lm.with_lemma(words, lemmas).collect()}
    assert got == {("en", "went"): "go", ("en", "cities"): "city", ("en", "floods"): "flood", ("en", "is"): "is",
                   ("en", "was"): "am", ("en", ""): "", ("en", "classes"): "class", ("xx", "floods"): "floods",
                   (None, "floods"): "floods", ("en", None): None}


def test_lemma_links_what_no_other_rule_links(spark):
    lemmas = spark.createDataFrame([("en", "went", "go"), ("en", "goes", "go")], "lang string, form string, lemma string")
    m = spark.createDataFrame([("0", "en", ["they", "went", "went"]), ("1", "fr", ["went"]), ("2", "en", None)],
                              "_row string, Language string, tok array<string>")
    kw = spark.createDataFrame([("en", "goes"), ("en", "goes home")], "lang string, keyword string")
    got = [tuple(r) for r in lm.lemma_pairs(m, kw, lemmas).collect()]
    assert got == [("0", "went", "goes", "go")]
    vocab = m.select(F.col("Language").alias("lang"), F.explode("tok").alias("term"))
    assert match_terms(vocab, kw.select("lang", F.col("keyword").alias("key"))).count() == 0


def test_matching_gives_one_row_a_pair_with_small_and_large_dictionaries(spark, monkeypatch):
    terms = spark.createDataFrame([("en", t) for t in ["gears", "gears", "gear", "bolts", "bolt"]] * 3, "lang string, term string")
    keys = spark.createDataFrame([("en", k) for k in ("gears", "bolt", "gears")], "lang string, key string")
    small = sorted(tuple(r) for r in match_terms(terms, keys).collect())
    import tidewatch.operators.matching as mt
    monkeypatch.setattr(mt, "proven_small", lambda df: False)
    monkeypatch.setattr(mt, "checked_broadcast", lambda df: df)
    large = sorted(tuple(r) for r in match_terms(terms, keys).collect())
    assert small == large and len(small) == len(set(small))
    assert ("en", "gear", "gears", False) in small and ("en", "bolt", "bolt", True) in small


def test_small_dictionary_shuffles_hits_only(spark):
    """No exchange below the dictionary joins: terms reach them from the scan."""
    terms = spark.range(1000).select(F.lit("en").alias("lang"), F.concat(F.lit("word"), "id").alias("term"))
    keys = spark.createDataFrame([("en", "word12345")], "lang string, key string")
    plan = match_terms(terms, keys)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("BroadcastHashJoin"):]
    assert "Exchange hashpartitioning(lang" not in below.split("BroadcastExchange")[0]


def test_nested_reference_folders_are_left_out(spark, tmp_path):
    os.makedirs(tmp_path / "keywords" / "en" / "deeper")
    (tmp_path / "keywords" / "en" / "a.csv").write_text("one,two\nthree\n")
    (tmp_path / "keywords" / "en" / "deeper" / "b.csv").write_text("four\n")
    rows = rd.read_refdata_lines(spark, str(tmp_path), "keywords").collect()
    assert sorted((r.lang, r.value, r.seq) for r in rows) == [("en", "one,two", 1), ("en", "three", 2)]
