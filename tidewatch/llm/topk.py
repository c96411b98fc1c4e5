"""Exact top-k search by inner product with a three-phase uniform threshold.

The score of a pair is the sum of ``slices`` partial scores, one per range of
dimensions; each slice is one list of the method.

1. Every block of vectors gives, per query and slice, its k highest partial
   scores; the full scores of these entries are gathered, and the k-th highest
   of a query is a safe cutoff (k entries reach it).
2. A score of at least the cutoff has a partial score of at least cutoff /
   slices, so each block collects the entries that reach this uniform
   threshold in some slice; all others are out.
3. The remaining entries' scores are resolved exactly and ranked.

Queries are handled in blocks of ``query_block`` rows against all vector
blocks (an equi-join on the query block's number), so nothing unbounded is
broadcast: a task holds one query block and one vector block. Cutoffs travel
with the query blocks.

Defined results: a vector that is null, or holds a null or non-finite
component, takes no part; an empty vector scores 0; vectors of several lengths
only meet others of their length; equal scores go to the smaller id; an id
that occurs twice counts as two candidates, and a query row is not its own
candidate (rows of the query's id are left out); a null id takes no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "query_id long, rank int, vec_id long, score long"
#: Above this bound on the size of a score, float64 sums are not exact.
_EXACT = float(1 << 53)
#: Tasks among which one query block's vector blocks are spread.
SALTS = 16


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float = 1024.0) -> DataFrame:
    """Rows (vec_id, dim, v): components as floor(scale * x); incomplete vectors are left out."""
    x = F.col(vector_col).cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        df.filter(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & F.coalesce(good, F.lit(False)))
        .select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.size(x).alias("dim"),
            F.transform(x, lambda c: F.floor(F.lit(scale) * c).cast("long")).alias("v"),
        )
    )


def _blob_rows(keys: list[str], out: str, size: int):
    """Packs the rows of each partition into blocks: ids and a matrix as bytes."""

    def run(parts):
        held: dict[tuple, list] = {}
        number = 0
        for pdf in parts:
            for row in pdf.itertuples(index=False):
                key = tuple(getattr(row, k) for k in keys)
                ids, vectors = held.setdefault(key, [[], []])
                ids.append(row.vec_id)
                vectors.append(np.asarray(row.v, np.int64))
                if len(ids) >= size:
                    yield _blob(keys, held.pop(key), key, out)
                    number += 1
        for key, block in held.items():
            yield _blob(keys, block, key, out)

    return run


def _blob(keys, block, key, out):
    ids, vectors = block
    matrix = np.stack(vectors) if len(vectors[0]) else np.zeros((len(ids), 0), np.int64)
    return pd.DataFrame(
        {**dict(zip(keys, key, strict=True)), f"{out}_ids": [np.asarray(ids, np.int64).tobytes()], f"{out}_v": [matrix.tobytes()]}
    )


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products; through float64 where no sum can leave its exact range."""
    if not q.size or not v.size:
        return np.zeros((len(q), len(v)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < _EXACT:
        return np.rint(q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    return q @ v.T


def _open(row, slices: int):
    dim = int(row.dim)
    q_ids, v_ids = (np.frombuffer(x, np.int64) for x in (row.q_ids, row.v_ids))
    q = np.frombuffer(row.q_v, np.int64).reshape(len(q_ids), dim)
    v = np.frombuffer(row.v_v, np.int64).reshape(len(v_ids), dim)
    cuts = np.linspace(0, dim, slices + 1).astype(int)
    parts = np.stack([_products(q[:, a:b], v[:, a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])
    own = q_ids[:, None] == v_ids[None, :]
    return q_ids, v_ids, parts, own


def _entries(q_ids, v_ids, total, chosen) -> pd.DataFrame:
    a, b = np.nonzero(chosen)
    return pd.DataFrame({"query_id": q_ids[a], "vec_id": v_ids[b], "score": total[a, b]})


def topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    slices: int = 2,
    query_block: int = 512,
    vector_block: int = 2048,
) -> DataFrame:
    """``vectors`` and ``queries`` as of ``integer_vectors``; rows (query_id, rank, vec_id, score)."""
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // query_block))
    q_blobs = (
        queries.select("vec_id", "dim", "v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("qb"))
        .repartition(blocks, "qb")
        .mapInPandas(_blob_rows(["dim", "qb"], "q", 2 * query_block), "dim int, qb long, q_ids binary, q_v binary")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    v_blobs = (
        vectors.mapInPandas(_blob_rows(["dim"], "v", vector_block), "dim int, v_ids binary, v_v binary")
        .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        .withColumn("salt", F.pmod(F.xxhash64("v_ids"), F.lit(SALTS)))
    )
    # Each query block meets vector blocks in up to SALTS tasks.
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    pairs = v_blobs.join(q_blobs.withColumn("salt", spread), ["qb", "salt", "dim"])

    def local_lists(parts):
        for pdf in parts:
            for row in pdf.itertuples(index=False):
                q_ids, v_ids, p, own = _open(row, slices)
                total, chosen = p.sum(0), np.zeros(own.shape, bool)
                m = min(k, len(v_ids))
                for part in np.where(own[None], np.iinfo(np.int64).min, p):
                    best = np.argpartition(part, len(v_ids) - m, axis=1)[:, len(v_ids) - m :]
                    np.put_along_axis(chosen, best, True, axis=1)
                yield _entries(q_ids, v_ids, total, chosen & ~own)

    cutoffs = (
        _ranked(pairs.mapInPandas(local_lists, "query_id long, vec_id long, score long"), k)
        .groupBy("query_id")
        .agg(F.min("score").alias("low"), F.count("*").alias("n"))
        .filter(F.col("n") >= k)
        .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
        .groupBy("qb")  # at most 2 * query_block rows of two numbers
        .agg(F.map_from_entries(F.collect_list(F.struct("query_id", "low"))).alias("low"))
    )

    def reaching(parts):
        for pdf in parts:
            for row in pdf.itertuples(index=False):
                q_ids, v_ids, p, own = _open(row, slices)
                low = dict(row.low) if row.low is not None else {}
                none = np.iinfo(np.int64).min
                cut = np.array([low.get(int(x), none) for x in q_ids], np.int64)
                # partial >= cutoff / slices, in whole numbers
                uniform = -((-cut) // slices)
                uniform[cut == none] = none
                some = (p >= uniform[None, :, None]).any(0) & ~own
                total = p.sum(0)
                yield _entries(q_ids, v_ids, total, some & (total >= cut[:, None]))

    known = q_blobs.join(cutoffs, "qb", "left").withColumn("salt", spread)
    again = v_blobs.join(known, ["qb", "salt", "dim"])
    collected = again.mapInPandas(reaching, "query_id long, vec_id long, score long")
    return _ranked(collected, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _ranked(entries: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return entries.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
