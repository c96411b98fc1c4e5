"""Fingerprints, line dedup, near duplicates, repeated strings and top-k against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import components, line_dedup, lsh_forest, simhash, suffix_dedup, topk

from . import edge

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def brute_components(data):
    sets = [(i, shingles(t)) for i, t in data if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 75 * len(s | t):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def near(docs):
    return lsh_forest.near_duplicates(docs).collect()


def test_near_duplicates_edge_cases(spark):
    data = [r for r in edge.rows() if r[0] != 7]
    out = near(edge.table(spark, data))
    assert len(out) == len(data)
    wanted = brute_components([(r[0], r[1]) for r in data])
    for r in out:
        assert r.component_id == (None if r.doc_id is None else wanted[r.doc_id])
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    size = {r[0]: len(shingles(r[1])) for r in data if r[0] is not None}
    assert all(r.n_shingles == size[r.doc_id] for r in out if r.doc_id is not None)
    assert near(edge.table(spark, [])) == []


def rows_of(data):
    """(id, set size, component) of every row by brute force; rows of an id with several texts stand apart."""
    sets = [shingles(t) if i is not None else set() for i, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(data)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(data):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((str(i), len(shingles(t)), None if i is None else least[find(k)]) for k, (i, t) in enumerate(data))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_with_repeated_ids(spark, seed):
    """Near copies around the limit, every id also on an unrelated text, some rows twice."""
    rng = random.Random(seed)
    words = edge.prose(rng, 110).split()
    data = [(r[0], r[1]) for r in edge.rows()] if seed == 1 else []
    for i in range(100, 250):
        w = list(words)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(len(w))] = edge.word(rng)
        data += [(i, " ".join(w)), (i, edge.prose(rng, rng.randint(20, 60)))]
    data += data[-40:-20]
    rng.shuffle(data)
    out = near(spark.createDataFrame(data, "doc_id long, text string").repartition(5))
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in out) == rows_of(data)


def test_near_duplicates_in_groups(spark, monkeypatch):
    """Groups of edits around the limit, one of them larger than a region may be for all pairs."""
    monkeypatch.setattr(lsh_forest, "FULL", 6)
    rng = random.Random(8)
    data, i = [], 0
    for size, edits in ((40, 2), (30, 4), (12, 6), (6, 8), (5, 10), (4, 14)):
        words = edge.prose(rng, 120).split()
        for _ in range(size):
            w = list(words)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = edge.word(rng)
            data.append((i, " ".join(w)))
            i += 1
    rng.shuffle(data)
    out = near(spark.createDataFrame(data, "doc_id long, text string").repartition(5))
    assert {r.doc_id: r.component_id for r in out} == brute_components(data)


def test_rare_pairs_find_all_links_across_components(spark):
    rng = random.Random(9)
    words = edge.prose(rng, 100).split()
    data = []
    for i in range(30):
        w = list(words)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = edge.word(rng)
        data.append((i, " ".join(w)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    base = lsh_forest._classed(docs)
    classes = base.groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    rest = classes.selectExpr("node", "node as root")
    pairs = lsh_forest._confirmed(lsh_forest._rare_pairs(rest, docs, classes), docs, classes).collect()
    node = {r.doc_id: r.node for r in base.collect()}
    sets = {node[i]: shingles(t) for i, t in data}
    wanted = {
        (min(a, b), max(a, b)) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    }
    assert {(r.a, r.b) for r in pairs} == wanted


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + k) for k in range(1, 60)] + [(500, 400), (7, 7)]
    for task_links in (components.TASK_LINKS, 20):  # one task, and several joined by rounds
        found = components.components(spark.createDataFrame(links, "a long, b long"), task_links=task_links)
        out = {r.node: r.root for r in found.collect()}
        assert all(out[i] == 0 for i in range(51)) and all(out[100 + k] == 100 for k in range(60)) and out[500] == 400
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_removed(data):
    docs = [(i, (t or "").encode()) for i, t in data]
    least = {}
    for i, b in docs:
        if i is not None:
            for p in range(len(b) - 49):
                k = b[p : p + 50]
                least[k] = min(i, least.get(k, i))
    out = []
    for i, b in docs:
        mask = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - 49):
                if least[b[p : p + 50]] < i:
                    mask[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, m in zip(b, mask, strict=True) if not m)
        spans = sum(1 for k, m in enumerate(mask) if m and not (k and mask[k - 1]))
        out.append((-1 if i is None else i, len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed(docs):
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_strings(docs).collect()
    )


def test_repeated_strings_edge_cases(spark):
    assert removed(edge.table(spark).repartition(3)) == brute_removed([(r[0], r[1]) for r in edge.rows()])
    assert removed(edge.table(spark, [])) == []


def test_repeated_strings_at_all_shifts(spark):
    rng = random.Random(10)
    passage = edge.prose(rng, 80)
    data = []
    for i in range(60):
        a = rng.randrange(300)
        data.append((rng.randrange(40), edge.prose(rng, 3)[: rng.randrange(12)] + passage[a : a + rng.choice((49, 50, 51, 52, 53, 90))] + edge.prose(rng, 2)))
    data += [(i, "ab" * rng.randrange(20, 60)) for i in range(50, 56)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    for parts in (1, 4):
        assert removed(docs.repartition(parts)) == brute_removed(data)
    kept = suffix_dedup.repeated_strings(docs, with_text=True).collect()
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in kept)


def brute_lines(data, min_lines=2, long_line=line_dedup.LONG_LINE, short_line=line_dedup.SHORT_LINE, common=line_dedup.COMMON):
    """Documents in order; which texts remain."""
    seen, out = set(), []
    spread = Counter(x for _, text in data for x in set((text or "").split("\n")))
    for _, text in data:
        if not text:
            out.append(text)
            continue
        lines = text.split("\n")
        solid = [(i, x) for i, x in enumerate(lines) if x.strip(" \t\r\f\v")]
        gone = set()
        found = []
        for p in range(len(solid)):
            windows = [tuple(solid[p : p + min_lines])] if p + min_lines <= len(solid) else []
            x = solid[p][1]
            if len(x) >= long_line or (len(x) >= short_line and spread[x] >= common):
                windows.append((solid[p],))
            for w in windows:
                key = (len(w), *(x for _, x in w))
                if key in seen:
                    found.append((p, p + len(w)))
                seen.add(key)
        merged = []
        for a, b in sorted(found):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            gone |= set(range(solid[a][0], solid[b - 1][0] + 1))
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(11)
    pool = [edge.prose(rng, 4) for _ in range(12)] + [edge.prose(rng, 60) for _ in range(3)] + ["", "  "]
    data = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(80)] + [(90, None), (91, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as k1", "2 as pos", "3 as row")
    for n, long_line, short_line, common in ((2, 240, 240, 1), (3, 240, 15, 24), (4, 40, 12, 10), (1, 10_000, 10_000, 1)):
        out = line_dedup.dedup_lines(docs, min_lines=n, long_line=long_line, short_line=short_line, common=common)
        assert out.columns == [*docs.columns, "_lines"]
        assert [r.text for r in out.orderBy("doc_id").collect()] == brute_lines(data, n, long_line, short_line, common)


def test_line_dedup_of_short_boilerplate(spark):
    """A line between unique lines goes by its length and the documents that have it, not by its number of places."""
    rng = random.Random(15)
    banner, title, sign = "Read more on our site", "Chapter one", "* * *"
    data = [(i, "\n".join([edge.prose(rng, 9), banner, edge.prose(rng, 9), sign, edge.prose(rng, 9)])) for i in range(12)]
    data += [(20, "\n".join(f"{title}\n{edge.prose(rng, 9)}" for _ in range(15)))]
    out = [r.text for r in line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).orderBy("doc_id").collect()]
    assert out == brute_lines(data)
    assert [banner in t for t in out[:12]] == [True] + [False] * 11 and all(sign in t for t in out[:12]) and out[12].count(title) == 15


def test_line_dedup_of_a_very_long_text(spark):
    rng = random.Random(16)
    pool = [edge.prose(rng, 3) for _ in range(3_000)]
    long = "\n".join(rng.choice(pool) for _ in range(20_000)) + "\n" + "same line here\n" * 20_000
    data = [(1, pool[0] + "\n" + pool[1]), (2, long), (3, "a" * 2_000_000)]
    out = line_dedup.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.text for r in out] == brute_lines(data)


def test_fingerprints_are_window_minima(spark):
    """Every window holds a selected line, and selected lines are least in one of their windows."""
    rng = random.Random(17)
    text = "\n".join(edge.word(rng) for _ in range(60))
    docs = spark.createDataFrame([(1, 1, text)], "k1 long, k2 long, text string")
    rows = line_dedup._lines(docs, "text", 5).collect()
    h = {r.pos: r.h for r in rows if r.around is None}
    wanted = {max((p + o for o in range(5)), key=lambda q: (-h[q], q)) for p in range(56)}
    assert {r.pos for r in rows if r.around is not None} == wanted and len(wanted) < 40
    assert all(r.around[r["at"]].h == r.h for r in rows if r.around is not None)


def test_line_dedup_edge_cases(spark):
    out = line_dedup.dedup_lines(edge.table(spark)).collect()
    assert len(out) == len(edge.rows())
    assert [r.text for r in out if r.doc_id == 3] == [None] and [r.text for r in out if r.doc_id == 4] == [""]
    assert len({r.text for r in out if r.doc_id == 0}) == 1  # repeated rows come out alike
    assert line_dedup.dedup_lines(edge.table(spark, [])).count() == 0


def test_fingerprints(spark):
    data = [(r[0], r[1]) for r in edge.rows() if r[0] is not None and r[0] != 7]
    out = simhash.fingerprint_documents(spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as c")).collect()
    assert len(out) == len(data)
    text = {i: t or "" for i, t in data}
    ids = sorted(text, reverse=True)
    by = {r.doc_id: r for r in out}
    for k, i in enumerate(ids):
        after = text[ids[(k + 1) % len(ids)]]
        cut = len(text[i]) // 3
        edited = text[i][: len(text[i]) - cut] + after[:cut]
        assert by[i].n_chars == len(text[i]) and by[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert by[0].fingerprint == by[1].fingerprint and by[4].fingerprint == "0" * 16
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert simhash.fingerprint_documents(edge.table(spark, [])).count() == 0
    assert simhash.fingerprint_documents(edge.table(spark)).count() == len(edge.rows())
    one = simhash.fingerprint_documents(spark.createDataFrame([(5, "a b c")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_votes_are_a_majority_per_bit(spark):
    df = spark.createDataFrame([(1, "a b c a b d e f"), (2, "a\tb")], "id long, text string")
    got = {r.id: r.fp for r in simhash.fingerprints(df, ["id"]).collect()}
    words = "a b c a b d e f".split()
    pairs = spark.createDataFrame(list(itertools.pairwise(words)), "w0 string, w1 string").selectExpr("xxhash64(w0, w1) as h").collect()
    votes = [sum((r.h >> b) & 1 for r in pairs) for b in range(64)]
    assert got[1] & ((1 << 64) - 1) == sum(1 << b for b in range(64) if 2 * votes[b] > len(pairs))


def test_permuted_tables_find_all_within_radius(spark):
    rng = random.Random(12)
    fps = {rng.getrandbits(63) for _ in range(60)}
    for f in list(fps):
        for _ in range(6):
            x = f
            for b in rng.sample(range(63), rng.randint(1, 5)):
                x ^= 1 << b
            fps.add(x)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for radius, blocks in ((3, 5), (3, 4), (2, 4)):
        got = {(r.q, r.fp) for r in simhash.within_radius(df, df, radius, blocks).collect()}
        assert got == {(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= radius}


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(13)
    data = [(i, [float(x) for x in rng.normal(size=6)], 1) for i in range(300)]
    data += [(300 + i, data[i][1], 1) for i in range(20)]  # ties
    data += [(400, None, 1), (500, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (600, [float("nan")] * 6, 1), (None, [0.0] * 6, 1), (700, [1.0, 2.0], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, dim int").repartition(3)
    v = topk.integer_vectors(df, "vec_id", "embedding")
    out = topk.topk(v, v.filter("vec_id % 100 = 0"), k=7, slices=3, query_block=2, vector_block=50)
    ints = {i: np.floor(1024 * np.array(x)).astype(np.int64) for i, x, _ in data[:320]}
    wanted = set()
    for q in (0, 100, 200, 300):
        scores = sorted((-int(ints[q] @ ints[c]), c) for c in ints if c != q)
        wanted |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(scores[:7])}
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in out.collect()} == wanted
    few = v.filter("vec_id < 4")
    assert topk.topk(few, few.filter("vec_id = 0"), k=10).count() == 3
    assert topk.topk(v.limit(0), v.limit(0)).count() == 0
