"""Toxicity, collocations and source divergence against plain Python versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewatch.llm import collocations, divergence, toxicity, word_codes
from tidewatch.llm.arrow_text import flat_bytes

from . import edge

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_collocations(rows, min_count, top):
    words, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    out = []
    found = {x: a for x, a in f.items() if a >= min_count and len(x[1]) > 1}
    for (lang, p), a in found.items():
        if any(la == lang and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for (la, q), b in found.items()):
            continue
        best = min(((1000 * a * words[lang]) // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        k = best[1]
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], words[lang], best[0]))
    ranked = defaultdict(list)
    for r in sorted(out, key=lambda r: (-r[6], -r[2], r[1].encode())):
        ranked[r[0]].append(r)
    return sorted((lang, i + 1, *r[1:]) for lang, rs in ranked.items() for i, r in enumerate(rs[:top]))


def phrase_rows():
    rng = random.Random(8)
    vocab = [edge.word(rng) for _ in range(25)] + ["Né", "漢字", "a\x00b"]
    rows = []
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(60)]
        if i % 3:
            words[10:10] = ["New", "York", "city", "hall"]
        rows.append(("".join(w + rng.choice([" ", "  ", "\t ", ". ", "\n", " "]) for w in words), rng.choice(["en", "fr", "", None])))
    rows += [("x y " * 200, "en"), ("same same same same", "de"), (None, "en"), ("", None), (" . ,", "en")] + [rows[1]] * 4
    return rows


@pytest.mark.parametrize("min_count,top", [(3, 2000), (12, 5)])
def test_collocations_equal_brute_force(spark, min_count, top):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, la, "k") for t, la in rows], "text string, lang string, phrase string").repartition(3)
    got = collocations.collocations(docs, min_count=min_count, top=top).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, min_count, top)


def test_collocations_of_edge_rows_and_empty_tables(spark):
    rows = edge.rows()
    got = collocations.collocations(edge.table(spark), min_count=4).collect()
    assert sorted(map(tuple, got)) == plain_collocations([(r[1], r[2]) for r in rows], 4, 2000)
    assert collocations.collocations(edge.table(spark, []), min_count=1).collect() == []


def test_summary_keeps_every_frequent_key_within_its_capacity():
    rng = np.random.default_rng(2)
    for threshold in (5, 100):
        keys = np.concatenate([rng.integers(0, 1 << 40, 40_000), np.repeat(np.arange(300), threshold), rng.integers(0, 3_000, 60_000)]).astype(np.uint64)
        rng.shuffle(keys)
        true = Counter(keys.tolist())
        summary = collocations.Summary(len(keys) // threshold + 1)
        for part in np.array_split(keys, 37):
            summary.add(*word_codes.counted(part))
            summary.merge()
            assert len(summary.keys) <= summary.capacity
        assert 0 < summary.loss < threshold
        kept = set(summary.survivors(threshold).tolist())
        assert {k for k, n in true.items() if n >= threshold} <= kept
        assert all(n <= true[k] for k, n in zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))


def test_bit_table_has_every_member(spark):
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 64, 5_000, np.uint64)
    hashes[:3] = 0, (1 << 64) - 1, 1 << 63
    df = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h long")
    bits = collocations.bit_table(df, "h")
    assert bits.has(hashes).all()
    assert bits.has(rng.integers(0, 1 << 64, 20_000, np.uint64)).mean() < 0.15


def test_long_rows_are_cut_only_after_separators():
    text = ("ab cd. " * 50 + "é" * 300 + " x\n" + "q " * 200).encode()
    data, off = np.frombuffer(b"kk" + text + b"zz", np.uint8), np.array([0, 2, 2 + len(text), 4 + len(text)])
    parts = list(word_codes.cut_slices(data, off, collocations._CUT, size=64))
    assert b"".join(p.tobytes() for _, p, _ in parts) == data.tobytes()
    assert all(p.tobytes()[-1:] in b".\n" for row, p, _ in parts[1:-2] if row == 1)
    assert [row for row, _, _ in parts] == sorted(row for row, _, _ in parts) and {row for row, _, _ in parts} == {0, 1, 2}


def plain_divergence(rows, min_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    occ, df, groups = Counter(), Counter(), sorted({(la, s) for _, la, s in rows})
    for text, la, s in rows:
        found = [t.translate(LOWER) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)]
        df.update({(la, t) for t in found})
        for t in found:
            occ[la, s, t] += 1
    out = []
    for la in sorted({g[0] for g in groups}):
        kept = [t for (x, t), n in df.items() if x == la and n >= min_docs]
        v, sources = len(kept), [s for x, s in groups if x == la]
        count = {s: {t: occ[la, s, t] for t in kept} for s in sources}
        whole = {t: sum(count[s][t] for s in sources) for t in kept}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v) for t in kept}  # noqa: B023, E731
        p, q = {s: share(count[s]) for s in sources}, share(whole)
        for s in sources:
            pair = sorted(((sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s), key=lambda r: (-r[0], r[1].encode()))
            out += [(la, s, "pair", o, f, i + 1) for i, (f, o) in enumerate(pair)]
            term = sorted(((p[s][t] - q[t], t) for t in kept if count[s][t] and p[s][t] > q[t]), key=lambda r: (-r[0], r[1].encode()))[:top]
            out += [(la, s, "term", t, f, i + 1) for i, (f, t) in enumerate(term)]
    return sorted(out)


@pytest.mark.parametrize("min_docs,top", [(2, 50), (6, 3), (1000, 5)])
def test_divergence_equals_brute_force(spark, min_docs, top):
    rng = random.Random(5)
    vocab = [edge.word(rng) for _ in range(60)] + ["É", "é", "Straße", "漢", "z9z"]
    rows = []
    for _ in range(160):
        lang, source = rng.choice(["en", "en", "fr", None, ""]), rng.choice(["a", "a", "b", "c", "é", None, ""])
        rows.append((" ".join(rng.choice(vocab[: 30 if source == "b" else 65]).title() for _ in range(rng.randint(0, 25))), lang, source))
    rows += [("only here", "xx", "s"), (None, "en", "new"), ("", "en", "void"), (rows[0])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, source string, n long").repartition(5)
    got = divergence.audit(docs, min_docs=min_docs, top=top).collect()
    assert sorted(map(tuple, got)) == plain_divergence(rows, min_docs, top)


def test_divergence_of_edge_rows_and_empty_tables(spark):
    got = divergence.audit(edge.table(spark), min_docs=2).collect()
    assert sorted(map(tuple, got)) == plain_divergence([(r[1], r[2], r[3]) for r in edge.rows()], 2, 50)
    assert divergence.audit(edge.table(spark, [])).collect() == []


def test_tree_flushes_keep_the_sums():
    rng = np.random.default_rng(1)
    paths = []
    for _ in range(400):
        at = np.flatnonzero(rng.random(9) < 0.5)
        if len(at):
            n = rng.integers(1, 4, len(at))
            paths.append(tuple(zip(at.tolist(), n.tolist(), (n * 10 + at).tolist(), (at * 3).tolist(), strict=True)))
    wanted, times = Counter(), Counter(paths)
    for path, m in times.items():
        for j, (h, _, p, b) in enumerate(path):
            for g, _, q, c in path[:j]:
                wanted[g, h] += m * (abs(p - q) - abs(p - c) - abs(b - q) + abs(b - c))
    for limit in (3, 1000):
        tree, got = divergence.PathTree(limit), Counter()
        batches = [b for path in sorted(times) for b in tree.insert("x", np.array(path), times[path])] + list(tree.rest())
        for b in batches:
            for g, h, v in zip(*(b.column(c).to_pylist() for c in ("lo", "hi", "v")), strict=True):
                got[g, h] += v
        assert got == wanted


def toxic_rows(n=600):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words, toxic = edge.prose(rng, rng.randint(5, 80)).split(), i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["Zonk", "zonked,", "vrex" + edge.word(rng)]))
        rows.append((i, " ".join(words), "x"))
        if i % 2 == 0 or rng.random() < 0.3:
            labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_is_learnt_from_positives_and_unlabelled(spark):
    rows, labels = toxic_rows()
    rows += [(9000, None, "x"), (9001, "", "x"), (None, "zonk", "x"), (9002, "zonk " * 20_000, "x"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4)
    marks = spark.createDataFrame(labels + [(9001, None), (None, 1), labels[0]], "doc_id long, toxic int")
    model = toxicity.learn(docs, marks)
    got = toxicity.scored(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r for r in got}
    apart = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 9000]
    hit = [r.predicted == int(r.doc_id % 8 == 0) for r in apart]
    assert sum(hit) / len(hit) > 0.95 and by_id[9000].score == by_id[9001].score < 0.5
    # Labels of the held-out fold are never read.
    other = spark.createDataFrame([(i, 1 - t if by_id[i].held_out else t) for i, t in labels], "doc_id long, toxic int")
    again = toxicity.learn(docs, other)
    assert np.array_equal(model["weights"], again["weights"]) and model["bias"] == again["bias"]


def test_toxicity_scores_equal_a_plain_version(spark):
    rng = np.random.default_rng(0)
    model = {"weights": rng.normal(size=toxicity.BUCKETS).astype(np.float32), "bias": -0.5}

    def plain(text):
        found = set()
        for w in re.findall(rb"[0-9a-z'\x80-\xff]+", (text or "").translate(LOWER).encode()):
            for x in toxicity.word_features(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0]:
                found.add(int(x))
        z = -0.5 + sum(float(model["weights"][x]) for x in sorted(found))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    got = toxicity.scored(edge.table(spark), model).collect()
    wanted = sorted((str(r[0]), round(plain(r[1]), 3)) for r in edge.rows())
    assert sorted((str(r.doc_id), round(r.score, 3)) for r in got) == wanted


def test_toxicity_without_learning_rows(spark):
    docs = edge.table(spark)
    for marks in ([], [(0, 0)]):
        model = toxicity.learn(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
        assert {(r.score, r.predicted) for r in toxicity.scored(docs, model).collect()} == {(0.0, 0)}
    assert toxicity.scored(edge.table(spark, []), None).collect() == []


def test_corrected_risk_holds_a_rare_class_apart():
    rng = np.random.default_rng(4)
    pos, unl = rng.normal(5, 1, 300), np.append(rng.normal(-5, 1, 1800), rng.normal(5, 1, 200))
    assert -2 < toxicity.least_risk(pos, unl, 0.1) < 2
    data, off = flat_bytes(__import__("pyarrow").array(["b a", None]))
    assert [x[0] for x in toxicity.text_features(data, off)] == [0]
