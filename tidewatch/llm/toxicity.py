"""Toxicity by non-negative positive-unlabelled learning.

Method. Only confirmed toxic texts are labelled; all other learning texts are
unlabelled, a mixture with a share ``prior`` of toxic ones. With the losses of
the positives as toxic (P+) and as clean (P-), and of the unlabelled as clean
(U-), the risk is prior * P+ + max(0, U- - prior * P-): the clean class's part
is the unlabelled risk corrected by the class prior and held from below zero,
where a step goes back instead. Linear numpy classifiers are trained with it,
each without one of ``FOLDS`` parts of the sample; their mean logit is the
score's. The logit at which the corrected 0-1 risk is least over the parts left
out, in the widest gap between scores where that is so, becomes 0.

Features of a text: the set of its words (between blanks and signs, A-Z
lower-cased) and of their beginnings of 4 to 6 bytes, hashed into ``BUCKETS``.
Those have a weight that stand in at least ``MIN_TEXTS`` texts of the training
part and are more frequent in the positives than in the unlabelled by
``CONTRAST`` standard errors of the log ratio; that many errors, up to 10, are
their scale.

Learning takes at most ``positives`` toxic and ``unlabelled`` other rows,
chosen by a hash of the id, one row of each id (a documented bound of the
sample); the prior is the toxic share of all labelled rows outside the held-out
fold. Scoring is one pass over whole texts without a shuffle.

Defined results: null and empty texts score as a text without words; without
a learning row of each kind every text scores 0; a null id stays null and
counts as held out; an id labelled both ways is toxic; ties and repeated rows
are scored each alike; very long texts are read whole, in one piece; an empty
table gives no rows; only id, text and label are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import flat_bytes, mix, row_slices, word_hashes
from .language import fold
from .word_codes import byte_class, coded_words, counted

BUCKETS = 1 << 18
MIN_TEXTS = 3
CONTRAST = 2.0
FOLDS = 5
BEGINNINGS = (4, 5, 6)
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_WORD = ~byte_class(bytes(range(0x00, 0x27)) + b"()*+,-./:;<=>?@[\\]^_`{|}~\"\x7f")


def word_features(chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Buckets of each word: itself and its beginnings (itself again where it is not longer)."""
    start, end = offsets[:-1], offsets[1:]
    out = [word_hashes(chars, start, end, lower=False)]
    for k in BEGINNINGS:
        cut = np.minimum(end, start + k)
        out.append(np.where(end - start > k, mix(word_hashes(chars, start, cut, lower=False) + np.uint64(k)), out[0]))
    return np.stack([(h % np.uint64(BUCKETS)).astype(np.int64) for h in out], 1)


def text_features(data: np.ndarray, offsets: np.ndarray, size: int = 1 << 20):
    """(first row, rows, features) of slices of the texts: the distinct features of each row, sorted."""
    for a, b in row_slices(offsets, size):
        w = coded_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], _WORD)
        wide = len(w.words)
        if not wide:
            continue
        held, _ = counted(w.row * wide + w.code)
        pairs, _ = counted(((held // wide)[:, None] * BUCKETS + word_features(*w.flat())[held % wide]).ravel())
        yield a, pairs // BUCKETS, pairs % BUCKETS


class Sparse:
    """Rows of feature numbers, as the products that training needs."""

    def __init__(self, rows: list[np.ndarray]):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.at = np.cumsum(self.sizes) - self.sizes
        self.features = np.concatenate(rows) if rows else np.zeros(0, np.int32)

    def batch(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of some rows, and the place in ``rows`` of each."""
        sizes = self.sizes[rows]
        own = np.repeat(np.arange(len(rows)), sizes)
        inside = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.features[self.at[rows][own] + inside], own


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train_linear(pos: Sparse, unl: Sparse, scale: np.ndarray, prior: float, epochs: int = 10, batch: int = 256, seed: int = 0) -> np.ndarray:
    """Weights of the features (the bias last) that lower the non-negative risk with the logistic loss, by Adam."""
    rng = np.random.default_rng(seed)
    width, draw = len(scale), batch // 4
    w, m, v = (np.zeros(width + 1) for _ in range(3))
    w[-1], step = np.log(prior / (1 - prior)), 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(unl.sizes)), max(1, len(unl.sizes) // batch)):
            fp, op = pos.batch(rng.integers(0, len(pos.sizes), draw))
            fu, ou = unl.batch(rows)
            zp = np.bincount(op, w[fp] * scale[fp], draw) + w[-1]
            zu = np.bincount(ou, w[fu] * scale[fu], len(rows)) + w[-1]
            sp, su = sigmoid(zp), sigmoid(zu)
            clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()  # risk of the clean class
            gu, back, gp = su / len(rows), -prior * sp / draw, -prior * (1 - sp) / draw
            gu, gp = (-gu, -back) if clean < 0 else (gu, gp + back)
            grad = np.bincount(fp, gp[op] * scale[fp], width + 1) + np.bincount(fu, gu[ou] * scale[fu], width + 1)
            grad[-1] += gp.sum() + gu.sum()
            grad[:-1] += 1e-3 * w[:-1]
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            w = w - 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def contrast(pos: list[np.ndarray], unl: list[np.ndarray]) -> np.ndarray:
    """Standard errors by which each bucket is more frequent in the positives; 0 below MIN_TEXTS texts."""
    a, b = (np.bincount(np.concatenate(x), minlength=BUCKETS).astype(np.float64) for x in (pos, unl))
    ratio = np.log((a + 0.5) / (len(pos) + 1)) - np.log((b + 0.5) / (len(unl) + 1))
    return np.where(a + b >= MIN_TEXTS, ratio / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)), 0)


def least_risk(pos: np.ndarray, unl: np.ndarray, prior: float) -> float:
    """The logit between scores with the least corrected 0-1 risk; of equal ones that in the widest gap."""
    at = np.unique(np.append(pos, unl))
    if len(at) < 2:
        return float(at[0])
    middle, gap = (at[1:] + at[:-1]) / 2, at[1:] - at[:-1]
    hit = 1 - np.searchsorted(np.sort(pos), middle) / len(pos)
    said = 1 - np.searchsorted(np.sort(unl), middle) / len(unl)
    risk = prior * (1 - hit) + np.maximum(0, said - prior * hit)
    best = np.flatnonzero(risk <= risk.min() + 1e-9)
    return float(middle[best[np.argmax(gap[best])]])


def fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, seed: int = 3) -> dict:
    """The mean of the classifiers as weights over all buckets."""
    rng = np.random.default_rng(seed)
    folds = [rng.permutation(len(x)) % FOLDS for x in (pos, unl)]
    weights, bias = np.zeros(BUCKETS), 0.0
    left = np.zeros(len(pos)), np.zeros(len(unl))
    for k in range(FOLDS):
        own = [[r for r, f in zip(x, fold_, strict=True) if f != k] for x, fold_ in zip((pos, unl), folds, strict=True)]
        if not own[0] or not own[1]:
            own = [pos, unl]
        z = contrast(*own)
        used = np.flatnonzero(z >= CONTRAST)
        place = np.full(BUCKETS, -1, np.int64)
        place[used] = np.arange(len(used))
        scale = np.minimum(z[used], 10) / 10
        w = train_linear(*[Sparse([(p := place[r])[p >= 0] for r in x]) for x in own], scale, prior, seed=k)
        part = np.zeros(BUCKETS)
        part[used] = w[:-1] * scale
        for x, fold_, out in zip((pos, unl), folds, left, strict=True):
            for i in np.flatnonzero(fold_ == k):
                out[i] = part[x[i]].sum() + w[-1]
        weights += part / FOLDS
        bias += w[-1] / FOLDS
    return {"weights": weights.astype(np.float32), "bias": float(bias - least_risk(*left, prior))}


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    positives: int = 2000, unlabelled: int = 6000,
) -> dict | None:
    """The model, or None without learning rows of both kinds."""
    known = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & (fold("id") != 0))
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    share = known.agg(F.avg("label")).first()[0]
    if not share:
        return None
    toxic = known.filter("label = 1").orderBy(F.xxhash64("id"), "id").limit(positives).select("id", F.lit(1).alias("toxic"))
    some = (
        docs.select(F.col(id_col).cast("long").alias("id")).filter(F.col("id").isNotNull() & (fold("id") != 0)).distinct()
        .orderBy(F.xxhash64("id", F.lit(1)), "id").limit(unlabelled).select("id", F.lit(0).alias("toxic"))
    )
    chosen = toxic.unionByName(some)  # an id may be in both: unlabelled texts are a draw from all
    sample = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(chosen), "id")  # at most positives + unlabelled rows of two numbers
        .groupBy("id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    )

    def features(batches):
        for batch in batches:
            data, off = flat_bytes(batch.column("text"))
            found = [b""] * batch.num_rows
            for a, row, feature in text_features(data, off):
                ends = np.searchsorted(row, np.arange(row[-1] + 2))
                for r in range(row[-1] + 1):
                    found[a + r] = feature[ends[r] : ends[r + 1]].astype(np.int32).tobytes()
            yield pa.record_batch([batch.column("id"), batch.column("toxic"), pa.array(found, pa.binary())], ["id", "toxic", "x"])

    rows = sorted(sample.mapInArrow(features, "id long, toxic int, x binary").collect())
    pos, unl = ([np.frombuffer(r.x, np.int32) for r in rows if r.toxic == t] for t in (1, 0))
    if not pos or not unl:
        return None
    return fit(pos, unl, min(max(share, 0.001), 0.9))


def scored(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Rows of SCHEMA for every whole text; ``predicted`` is 1 from ``threshold`` on."""
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (fold(id_col) == 0).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    if model is None:
        return read.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(int(threshold <= 0)).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    def run(batches):
        weights, bias = shared.value["weights"], shared.value["bias"]
        for batch in batches:
            data, off = flat_bytes(batch.column("text"))
            z = np.full(batch.num_rows, bias)
            for a, row, feature in text_features(data, off):
                z[a : a + row[-1] + 1] += np.bincount(row, weights[feature])
            s = sigmoid(z)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return read.mapInArrow(run, SCHEMA)
