"""Language identification with string kernels.

Method: blended-spectrum presence kernel. A text is the set of its byte
n-grams, n = 1 to ``MAX_N``, hashed into ``DIM`` buckets; the kernel of two
texts is the size of the common set over the geometric mean of the two sizes.
Nystroem landmarks (a bounded sample of learning rows) turn it into features,
and one-versus-rest kernel ridge regression is fitted on them. Texts are scored
in batches: presence matrix times landmark matrix, then times the weights.

Fitting takes at most ``per_lang`` rows of each language and ``max_rows`` of all
(documented bounds of the learning sample; chosen by a hash of the id). Scoring is
one pass without a shuffle over whole texts, ``SLICE_ROWS`` rows a matrix.

Defined results: a text that is null or has no letter gets ``und`` and score
0; a very long text is read whole, alone in its matrix; of languages that score
alike the first by name is taken; without any learning row every text gets ``und`` and 0; a null id stays
null and counts as held out; repeated rows are scored each; an empty table
gives no rows; columns other than id, text and language are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import LOWER, flat_bytes, mix, row_slices
from .tables import stored

DIM = 1 << 14
MAX_N = 4
SLICE_ROWS = 512  # rows of a dense matrix: 64 kB each as floats, however short the texts
RANK_PARTS = 64
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"

#: Lower-case letters and bytes of other scripts stand; all else is a blank.
_CLASS = LOWER.copy()
_CLASS[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def fold(id_col: str, folds: int = 5):
    """crc32 of the id as text modulo ``folds``; 0 is held out (a null id too)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0))


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows by DIM: whether a text holds an n-gram of the bucket."""
    rows = len(offsets) - 1
    out = np.zeros(rows * DIM, bool)
    if not len(data):
        return out.reshape(rows, DIM)
    chars = _CLASS[data].astype(np.uint64)
    row = np.repeat(np.arange(rows, dtype=np.int64) * DIM, np.diff(offsets))
    grams = np.zeros(len(chars), np.uint64)
    for n in range(1, MAX_N + 1):
        if len(chars) < n:
            break
        grams = grams[: len(chars) - n + 1] * np.uint64(256) + chars[n - 1 :]
        inside = row[: len(grams)] == row[n - 1 :]
        bucket = (mix(grams + np.uint64(n << 40)) >> np.uint64(64 - 14)).astype(np.int64)
        out[(row[: len(grams)] + bucket)[inside]] = True
    return out.reshape(rows, DIM)


def fit(x: np.ndarray, labels: list[str], landmarks: int = 256, ridge: float = 1e-2, seed: int = 7) -> dict:
    """Landmarks and one-versus-rest ridge weights from presence rows."""
    names = sorted(set(labels))
    size = np.sqrt(np.maximum(x.sum(1), 1)).astype(np.float32)
    rng = np.random.default_rng(seed)
    by_name = [rng.permutation([i for i, v in enumerate(labels) if v == name]) for name in names]
    order = [v[k] for k in range(max(map(len, by_name))) for v in by_name if k < len(v)]
    chosen = np.sort(order[:landmarks])
    z, z_size = x[chosen].astype(np.float32), size[chosen]
    shared = np.concatenate([x[a : a + SLICE_ROWS].astype(np.float32) @ z.T for a in range(0, len(x), SLICE_ROWS)])
    kernel = shared / size[:, None] / z_size[None, :]
    values, vectors = np.linalg.eigh(kernel[chosen].astype(np.float64))
    keep = values > 1e-6 * values.max()
    to_features = vectors[:, keep] / np.sqrt(values[keep])
    feats = np.column_stack([kernel @ to_features, np.ones(len(x))])
    target = np.array([[1.0 if v == name else -1.0 for name in names] for v in labels])
    # Each language counts alike, however many rows it has.
    rows_of = Counter(labels)
    weight = np.array([1.0 / rows_of[v] for v in labels])
    gram = (feats * weight[:, None]).T @ feats + ridge * np.eye(feats.shape[1]) * weight.sum() / len(labels)
    solved = np.linalg.solve(gram, (feats * weight[:, None]).T @ target)
    return {
        "names": names, "z": (z / z_size[:, None]).T.astype(np.float32),
        "w": (to_features @ solved[:-1]).astype(np.float32), "b": solved[-1].astype(np.float32),
    }


def predict(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the best language of each presence row, and its share of a softmax."""
    x = x.astype(np.float32)
    out = ((x @ model["z"]) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))) @ model["w"] + model["b"]
    power = np.exp(4 * (out - out.max(1, keepdims=True)))
    share = power / power.sum(1, keepdims=True)
    best = share.argmax(1)
    return best, share[np.arange(len(best)), best]


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 400, max_rows: int = 12_000
) -> dict | None:
    """Fits on at most ``per_lang`` rows of each language, none of them held out and no id twice in one.

    With so many languages that this passes ``max_rows`` (16 kB each on the driver),
    each gets an equal share of them, one row at least. Ids are ranked within
    ``RANK_PARTS`` parts of a language first, so a task ranks at most
    ``RANK_PARTS * per_lang`` of them, however many rows a language has.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text")
    ).filter(F.col("label").isNotNull() & F.col("text").isNotNull() & (fold("id") != 0))
    order = [F.xxhash64("id"), F.col("id")]
    ids = rows.select("id", "label").distinct().withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(RANK_PARTS)))
    own = ids.withColumn("k", F.row_number().over(Window.partitionBy("label", "part").orderBy(*order))).filter(F.col("k") <= per_lang)
    first = own.withColumn("k", F.row_number().over(Window.partitionBy("label").orderBy(*order))).filter(F.col("k") <= per_lang)
    first = stored(first.select("id", "label", "k"))
    langs = first.select("label").distinct().count()
    share = max(1, min(per_lang, max_rows // max(langs, 1)))
    chosen = first.filter(F.col("k") <= share).select("id", "label")

    def run(batches):
        for batch in batches:
            data, off = flat_bytes(batch.column(1))
            packed = [
                np.packbits(row).tobytes()
                for a, b in row_slices(off, 1 << 20, SLICE_ROWS)
                for row in presence(data[off[a] : off[b]], off[a : b + 1] - off[a])
            ]
            yield pa.record_batch([batch.column(0), pa.array(packed, pa.binary())], ["label", "bits"])

    sample = (
        rows.join(F.broadcast(chosen), ["id", "label"], "left_semi")  # at most max_rows ids, or one of each language
        .groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))  # one row of each
        .select("label", "text").mapInArrow(run, "label string, bits binary").collect()
    )
    if not sample:
        return None
    sample.sort(key=lambda r: (r.label, zlib.crc32(r.bits), r.bits))
    x = np.stack([np.unpackbits(np.frombuffer(r.bits, np.uint8)).astype(bool) for r in sample])
    return fit(x, [r.label for r in sample])


def identify(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of SCHEMA for every whole text."""
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (fold(id_col) == 0).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    if model is None:
        return read.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x landmarks floats, whatever the input

    def run(batches):
        m = shared.value
        for batch in batches:
            data, off = flat_bytes(batch.column("text"))
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            best, share = np.zeros(len(letters), np.int64), np.zeros(len(letters))
            for a, b in row_slices(off, 1 << 18, SLICE_ROWS):
                best[a:b], share[a:b] = predict(m, presence(data[off[a] : off[b]], off[a : b + 1] - off[a]))
            names = [m["names"][k] if ok else "und" for k, ok in zip(best, letters, strict=True)]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(np.where(letters, share, 0.0), pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return read.withColumn("letters", has_letter).mapInArrow(run, SCHEMA)
