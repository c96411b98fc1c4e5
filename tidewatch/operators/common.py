"""Shared plan helpers: size-checked broadcast, lineage cuts, row keys."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Largest table (bytes) that is hinted for broadcast.
BROADCAST_MAX_BYTES = 64 << 20
# Writer options for text and JSON files: gzip at its fastest level (the default one takes several times as long).
FAST_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# Bytes a row costs in a hash relation besides its values.
ROW_OVERHEAD = 64


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan: exact for literal tables, an upper
    bound for scans and what filters and projects them, and huge (so never
    broadcast) for joins of them. Planning only, no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a materialised table: the length of its rows as JSON plus a
    fixed overhead a row (one aggregate over a copy that is already written)."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + F.lit(ROW_OVERHEAD))
    return int(df.agg(size.alias("b")).first()["b"] or 0)


def is_deterministic(df: DataFrame) -> bool:
    """Whether the plan holds no random values or generated numbers, so that reading it twice gives the same rows."""
    return bool(df._jdf.queryExecution().analyzed().deterministic())


def proven_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the size estimate of a plan, an upper bound, allows its broadcast."""
    return estimated_bytes(df) <= max_bytes


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its estimated size proves it small; otherwise
    leave the join strategy to the planner (AQE may still convert the join from
    measured shuffle sizes). No job is run."""
    return F.broadcast(df) if proven_small(df, max_bytes) else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (shared storage on a
    cluster), computing the input once: it is persisted while the checkpoint
    job writes it, then released."""
    from tidewatch.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = df.checkpoint(eager=True)
    df.unpersist()
    return out


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in one job. Unlike a persisted copy (``cut_lineage``),
    which keeps every shuffle partition, it is written in as few parts as the
    measured sizes of its shuffles ask for."""
    from tidewatch.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """A data-derived lookup table (e.g. term → match map) for a join with a
    big table: materialised once (checkpoint), measured in bytes on the
    materialised copy, broadcast when within ``max_bytes``, else joined by shuffle."""
    m = cut_lineage(df)
    return F.broadcast(m) if measured_bytes(m) <= max_bytes else m


def numbered(df: DataFrame, order: list[str], out: str = "pos") -> DataFrame:
    """Rows numbered from 1 in the order of ``order`` without one task seeing
    them all: a range-partitioned sort, numbers within each range, and the
    ranges' offsets (one row per partition)."""
    placed = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return placed.join(F.broadcast(offsets), "_part").withColumn(
        out, (F.row_number().over(inside) + F.col("_before")).cast("long")).drop("_part", "_before")


def with_row_key(df: DataFrame, key: str = "_row", id_col: str | None = None) -> DataFrame:
    """Attach a row key: the given id column, else a generated one.

    A generated key depends on the input partition and row position, which two
    evaluations of a plan with a shuffle need not share. Whoever joins back on
    it must go through one stored copy (``cut_lineage``) of the keyed rows.
    """
    if id_col and id_col in df.columns:
        return df.withColumn(key, F.col(id_col).cast("string"))
    return df.withColumn(key, F.monotonically_increasing_id().cast("string"))
