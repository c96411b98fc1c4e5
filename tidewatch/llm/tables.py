"""Intermediate tables of this package: written to the shared folder, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidewatch.session import scratch_dir


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder. It cuts the lineage, keeps no copy in the
    executors' memory, and tells the planner its size; rows and their order may be dealt anew."""
    path = scratch_dir(df.sparkSession, f"table-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
