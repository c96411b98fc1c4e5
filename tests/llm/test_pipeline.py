"""The corpus pipeline, stage by stage, against plain versions."""

import random

import corpus_pipeline
from tidewatch.llm import pii

from . import edge
from .test_duplicates import brute_components, brute_lines


def _tables(spark, folder):
    rng = random.Random(21)
    good = [edge.prose(rng, 60).capitalize() + "." for _ in range(60)]
    passage = edge.prose(rng, 70)
    texts = []
    for i in range(120):
        if i % 4 == 0:
            texts.append(" ".join(w.upper() + "!!" for w in edge.prose(rng, 40).split()))
        else:
            body = good[i % 60]
            if i % 5 == 0:
                body += "\n" + passage
            if i % 7 == 0:
                body += f"\nwrite to a{i}@mail.example.org or 10.0.0.{i}"
            if i % 11 == 0:
                body = body.replace(" ", " x ", 1)
            texts.append(body)
    rows = [(i, t, "en", "s", len(t), "extra") for i, t in enumerate(texts)]
    rows += [(None, good[3], None, None, None, None), (500, None, "en", "s", None, None), (501, "", "en", "s", 0, None), rows[1]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 4 != 0), 0) for i in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_and_run(spark, tmp_path):
    sf = str(tmp_path / "sf")
    _tables(spark, sf)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "quality":
            ids = {r.doc_id for r in kept[name]}
            assert not ids & {i for i in range(120) if i % 4 == 0} and {i for i in range(120) if i % 4} <= ids
        if name == "line_dedup":
            order = sorted({(-1 if r.doc_id is None else r.doc_id, r.text) for r in before.collect()}, key=lambda r: (r[0], r[1] or ""))
            left = dict(zip(order, brute_lines(order), strict=True))
            wanted = sorted(
                (i, t) for r in before.collect() for i in [-1 if r.doc_id is None else r.doc_id]
                for t in [left[(i, r.text)]] if not (r.text and r.text.strip() and not t.strip()) and t is not None
            )
            assert sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in kept[name] if r.text is not None) == wanted
        if name == "near_dedup":
            root = brute_components(sorted({(r.doc_id, r.text) for r in before.collect() if r.doc_id is not None}, key=str))
            assert {r.doc_id for r in kept[name]} - {None} == {i for i in root if root[i] == i}
        if name == "pii":
            assert not any(pii.base_spans(r.text) for r in kept[name] if r.text)
            assert any("[EMAIL]" in r.text and "[IP]" in r.text for r in kept[name] if r.text)
    # The prose of the small table is random, so rows differ only in how sequences are numbered.
    once = corpus_pipeline.run(spark, sf)
    key = lambda rows: sorted((r.doc_id or -1, r.start, r.length, r.ids_crc32) for r in rows)
    assert sum(r.length for r in once.collect()) == sum(r.length for r in kept["packing"])
    assert {k[0] for k in key(once.collect())} == {k[0] for k in key(kept["packing"])}


def test_empty_table(spark, tmp_path):
    sf = str(tmp_path / "sf")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
