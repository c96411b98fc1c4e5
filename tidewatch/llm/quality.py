"""Quality classifier on pooled random-indexing word vectors.

Method: every term bucket has a fixed sparse ternary index vector; its word
vector is the (centred, scaled) sum of the index vectors of the terms around
its occurrences in the corpus, plus its own index vector. A word gives
two terms: its lower-cased letters, and its shape (classes of its first and
last bytes, and whether it repeats the word before). A text is the mean and the
spread of its terms' vectors. A two-layer numpy network scores it, and a
temperature fitted on rows apart calibrates the probability.

Word vectors are summed by a Spark job over all texts outside the held-out fold
(no labels are read for them). The network is fitted on at most ``per_label``
labelled rows of each label, chosen by a hash of the id (a documented bound of
the sample). Scoring is one pass over whole texts, no shuffle.

Defined results: null and empty texts score as a text without words; without
learning rows of both labels every text scores 0.5; a null id stays null and
counts as held out; repeated rows are scored each; conflicting labels of an id
all count; a very long text is read whole, in slices of whole rows; equal scores stay
tied; an empty table gives no rows; only id, text and label are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import LOWER, flat_bytes, mix, row_slices, word_hashes, words
from .language import fold
from .tables import stored

BUCKETS = 1 << 14
WIDTH = 48
BLOCKS = 16
ADDED = 32  # tasks whose sums are added at a time
_PARTS = "task int, block int, sums binary"
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

#: Byte classes of a word's shape: a letter, A capital, 9 digit, u other script; signs stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("9")
_SHAPE[128:] = ord("u")


def index_vectors(seed: int = 11) -> np.ndarray:
    """Sparse ternary vectors, alike on every machine: four entries of +1 and four of -1."""
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    place = rng.random((BUCKETS, WIDTH)).argsort(1)[:, :8]
    np.put_along_axis(out, place[:, :4], 1, axis=1)
    np.put_along_axis(out, place[:, 4:], -1, axis=1)
    return out / np.float32(np.sqrt(8))


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket and shape bucket of each word, and its row."""
    starts, ends, row = words(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none
    h = word_hashes(data, starts, ends)
    same = np.zeros(len(h), np.uint64)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    c = _SHAPE[data]
    length = ends - starts
    pick = lambda at, ok: np.where(ok, c[np.clip(at, 0, len(c) - 1)], 0).astype(np.uint64)
    shape = (
        pick(starts, length > 0) + pick(starts + 1, length > 1) * np.uint64(1 << 8)
        + pick(ends - 1, length > 2) * np.uint64(1 << 16) + pick(ends - 2, length > 3) * np.uint64(1 << 24)
        + same * np.uint64(1 << 32) + np.uint64(1 << 40)
    )
    bucket = lambda x: (x % np.uint64(BUCKETS)).astype(np.int64)
    return bucket(h), bucket(mix(shape)), row


def context_sums(data: np.ndarray, offsets: np.ndarray, signs: np.ndarray, out: np.ndarray) -> None:
    """Adds to ``out`` the index vectors, in whole signs, of the neighbours of every term."""
    word, shape, row = terms(data, offsets)
    if len(word) < 2:
        return
    own = signs[word] + signs[shape]
    beside = (row[1:] == row[:-1])[:, None]
    around = np.zeros_like(own)
    around[1:] += own[:-1] * beside
    around[:-1] += own[1:] * beside
    for keys in (word.astype(np.uint16), shape.astype(np.uint16)):
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        out[keys[order][first]] += np.add.reduceat(around[order], first, axis=0, dtype=np.float64)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of each text: mean and spread of the vectors of its words and shapes."""
    rows = len(offsets) - 1
    out = np.zeros((rows, 4 * WIDTH + 2), np.float32)
    for a, b in row_slices(offsets, 1 << 18):
        word, shape, row = terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        if not len(word):
            continue
        first = np.flatnonzero(np.r_[True, np.diff(row) > 0])
        count = np.diff(np.r_[first, len(row)])[:, None]
        at = a + row[first]
        for k, own in enumerate((word, shape)):
            v = vectors[own]
            mean = np.add.reduceat(v, first, axis=0) / count
            square = np.add.reduceat(v * v, first, axis=0) / count
            out[at, 2 * k * WIDTH : (2 * k + 1) * WIDTH] = mean
            out[at, (2 * k + 1) * WIDTH : (2 * k + 2) * WIDTH] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[at, 4 * WIDTH] = np.log1p(count[:, 0])
        out[at, 4 * WIDTH + 1] = 1
    return out


def train_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 5) -> dict:
    """Two layers by Adam on balanced weights; then a temperature on rows apart."""
    rng = np.random.default_rng(seed)
    mean, std = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / std
    order = rng.permutation(len(x))
    apart, own = order[: len(x) // 5], order[len(x) // 5 :]
    if len(set(y[own])) < 2 or len(set(y[apart])) < 2:
        apart = own = order
    p = {
        "w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), "b1": np.zeros(hidden),
        "w2": rng.normal(0, 1 / np.sqrt(hidden), hidden), "b2": np.zeros(()),
    }
    m, v, step = {k: 0 * a for k, a in p.items()}, {k: 0 * a for k, a in p.items()}, 0
    share = y[own].mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(own), max(1, len(own) // 128)):
            h = np.tanh(x[at] @ p["w1"] + p["b1"])
            out = 1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30)))
            d = (out - y[at]) * weight[at] / len(at)
            dh = d[:, None] * p["w2"][None, :] * (1 - h * h)
            g = {"w1": x[at].T @ dh, "b1": dh.sum(0), "w2": h.T @ d, "b2": d.sum()}
            step += 1
            for k in p:
                grad = g[k] + (1e-4 * p[k] if k[0] == "w" else 0)
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad**2
                p[k] = p[k] - 2e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    logit = np.tanh(x[apart] @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]

    def loss(t: float) -> float:
        z = np.clip(logit / t, -30, 30)
        return float((weight[apart] * (np.logaddexp(0, z) - y[apart] * z)).mean())

    temperature = min(np.geomspace(0.25, 8, 41), key=loss)
    return {k: a.astype(np.float32) for k, a in p.items()} | {
        "mean": mean.astype(np.float32), "std": std.astype(np.float32), "t": float(temperature)
    }


def score(model: dict, x: np.ndarray) -> np.ndarray:
    h = np.tanh(((x - model["mean"]) / model["std"]) @ model["w1"] + model["b1"])
    return 1 / (1 + np.exp(-np.clip((h @ model["w2"] + model["b2"]) / model["t"], -30, 30).astype(np.float64)))


def corpus_contexts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """BUCKETS x WIDTH sums of the index vectors around every term, over all texts outside the held-out fold.

    Each task sums its texts into BLOCKS rows of a fixed size; these are added
    ADDED tasks at a time, so no task holds more than ADDED of them, and BLOCKS
    rows come to the driver whatever the input. Sums are of whole signs, so
    they do not depend on how the texts were dealt to tasks.
    """

    def sums(batches):
        signs, out = np.sign(index_vectors()), np.zeros((BUCKETS, WIDTH))
        for batch in batches:
            data, off = flat_bytes(batch.column("text"))
            for a, b in row_slices(off, 1 << 18):
                context_sums(data[off[a] : off[b]], off[a : b + 1] - off[a], signs, out)
        if out.any():
            blocks = [x.astype(np.int64).tobytes() for x in np.split(out, BLOCKS)]
            task = pa.array([TaskContext.get().partitionId()] * BLOCKS, pa.int32())
            yield pa.record_batch([task, pa.array(range(BLOCKS), pa.int32()), pa.array(blocks, pa.binary())], ["task", "block", "sums"])

    def added(key, pdf):
        total = sum(np.frombuffer(x, np.int64) for x in pdf["sums"])
        return pd.DataFrame({"task": [key[0]], "block": [key[1]], "sums": [total.tobytes()]})

    learning = docs.filter(fold(id_col) != 0).select(F.col(text_col).cast("string").alias("text"))
    parts = stored(learning.mapInArrow(sums, _PARTS))
    tasks = parts.agg(F.max("task")).first()[0]
    if tasks is None:
        return np.zeros((BUCKETS, WIDTH))
    while tasks > 0:
        tasks //= ADDED
        parts = parts.groupBy(F.floor(F.col("task") / ADDED).cast("int").alias("task"), "block").applyInPandas(added, _PARTS)
    rows = sorted(parts.collect(), key=lambda r: r.block)
    return np.concatenate([np.frombuffer(r.sums, np.int64) for r in rows]).reshape(BUCKETS, WIDTH).astype(np.float64)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_label: int = 3000
) -> dict | None:
    """The model, or None without learning rows of both labels."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull() & (fold("id") != 0)
    )
    parts = [known.filter(F.col("label") == v).distinct().orderBy(F.xxhash64("id"), "id").limit(per_label) for v in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    sample = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(chosen), "id")  # 2 * per_label rows of two numbers
        .groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))  # one row of each
        .repartition(8, "id")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )

    def features(vectors):
        def run(batches):
            for batch in batches:
                data, off = flat_bytes(batch.column("text"))
                x = pooled(data, off, vectors.value)
                yield pa.record_batch(
                    [batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "label", "x"]
                )

        return run

    try:
        if sample.select("label").distinct().count() < 2:
            return None
        context = corpus_contexts(docs, id_col, text_col)
        norm = np.linalg.norm(context, axis=1, keepdims=True)
        unit = context / np.maximum(norm, 1e-9)
        seen = norm[:, 0] > 0
        unit[seen] -= unit[seen].mean(0)
        vectors = (index_vectors() + unit).astype(np.float32)
        shared = docs.sparkSession.sparkContext.broadcast(vectors)
        rows = sorted(sample.mapInArrow(features(shared), "id long, label int, x binary").collect())
    finally:
        sample.unpersist()
    y = np.array([r.label for r in rows], np.float64)
    if len(set(y)) < 2:
        return None
    x = np.stack([np.frombuffer(r.x, np.float32) for r in rows]).astype(np.float64)
    return train_network(x, y) | {"vectors": vectors}


def scored(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Rows of SCHEMA for every whole text; ``predicted`` is 1 from ``threshold`` on."""
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (fold(id_col) == 0).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    if model is None:
        return read.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(int(threshold <= 0.5)).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of floats

    def run(batches):
        for batch in batches:
            data, off = flat_bytes(batch.column("text"))
            s = score(shared.value, pooled(data, off, shared.value["vectors"]))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                 pa.array((s >= threshold).astype(np.int32), pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return read.mapInArrow(run, SCHEMA)


def good_documents(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            data, off = flat_bytes(batch.column(text_col))
            s = score(shared.value, pooled(data, off, shared.value["vectors"]))
            yield batch.filter(pa.array(s >= threshold))

    return docs.mapInArrow(run, docs.schema)
