import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import fuzzy as fz
from tidewatch.operators.matching import fuzzy_pairs


def brute_lcs(a, b):
    best = 0
    for i in range(len(a)):
        for j in range(i + 1, len(a) + 1):
            if a[i:j] in b:
                best = max(best, j - i)
    return best


def brute_match(a, b):
    if a == b:
        return True
    L = brute_lcs(a, b)
    if L == 0:
        return False
    if 1 - L / min(len(a), len(b)) < 0.2 and 1 - L / max(len(a), len(b)) < 0.2:
        return fz._jaro_winkler(a, b) > 0.5
    return False


@pytest.mark.parametrize("a,b,expected", [
    ("gear", "gears", True),        # 4/5: ratio exactly 0.8 passes
    ("rod", "rods", False),         # 3/4
    ("plate", "plates", True),      # 5/6
    ("abcdefgh", "abcdefghij", True),   # 8/10 exactly 0.8
    ("abcdefg", "abcdefgxy", False),    # 7/9
    ("", "a", False),
    ("same", "same", True),
])
def test_fuzzy_boundaries(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    got = df.select(fz.fuzzy_match("a", "b").alias("m"), fz.fuzzy_match("b", "a").alias("r")).first()
    assert got.m == expected and got.r == expected  # symmetric
    assert brute_match(a, b) == expected


def test_jaro_winkler_published_values():
    assert round(fz._jaro_winkler("martha", "marhta"), 3) == 0.961
    assert round(fz._jaro_winkler("dwayne", "duane"), 3) == 0.840
    assert round(fz._jaro_winkler("dixon", "dicksonx"), 3) == 0.813
    assert fz._jaro_winkler("abc", "xyz") == 0.0


def test_lcs_native_matches_brute(spark):
    rnd = random.Random(7)
    pairs = [("".join(rnd.choice("ab") for _ in range(rnd.randint(1, 8))),
              "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 8)))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.l for r in df.select(fz.lcs_length("a", "b").alias("l")).collect()]
    assert got == [brute_lcs(a, b) for a, b in pairs]


words = st.text(alphabet="abc", min_size=1, max_size=9)


@settings(max_examples=8, deadline=None)
@given(st.lists(words, min_size=1, max_size=12, unique=True), st.lists(words, min_size=1, max_size=6, unique=True))
def test_gram_blocking_equals_brute_force(spark, terms, keys):
    t = spark.createDataFrame([("en", x) for x in terms], "lang string, term string")
    k = spark.createDataFrame([("en", x) for x in keys], "lang string, key string")
    got = {(r.term, r.key) for r in fuzzy_pairs(t, k).collect()}
    want = {(a, b) for a in terms for b in keys if a != b and brute_match(b, a)}
    assert got == want


def test_native_jaro_winkler_equals_python_reference(spark):
    rnd = random.Random(11)
    alpha = "abcé ñx"
    pairs = [("".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 9))),
              "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 9)))) for _ in range(400)]
    pairs += [("martha", "marhta"), ("", ""), ("a", "")]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("i", F.monotonically_increasing_id())
    rows = fz.add_jaro_winkler(df, "a", "b", "n").withColumn("p", fz.jaro_winkler("a", "b")).orderBy("i").collect()
    assert all(r.n == r.p for r in rows)
    assert [r.n for r in rows[-3:]] == [fz._jaro_winkler("martha", "marhta"), 1.0, 0.0]
