"""Readers for the parquet tables a job is given."""

from __future__ import annotations

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan over the cluster when it has fewer splits than cores.

    A file written as one row group is a single scan task, and everything
    fused into that stage (parsing, tokenising, explode, partial aggregation)
    then runs on one core. Large inputs have many splits and are returned
    unchanged (no extra shuffle); the check is planning-only (no job).
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except (AttributeError, PySparkNotImplementedError):  # a remote session has no RDDs: leave the scan as is
        return df
    return df.repartition(target) if splits < target else df


def table(spark: SparkSession, root: str, name: str, spread_small: bool = False) -> DataFrame:
    """Parquet table ``<root>/<name>.parquet`` (filters and projections push down)."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_small else df
