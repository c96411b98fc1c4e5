"""S15 + T1: pass-through archives under the late policy, each a query of its own.

An archive writes the rows of its stream as JSON files, without rows that are
later than the tolerance and without repeated deliveries of a key (T1). What the
policy leaves out is counted per micro-batch by the query's own metrics, so no
row is scanned for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.streaming.pipelines import LATE_TOLERANCE, late_events

_KEPT_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"


def run_archive(stream: DataFrame, out_path: str, checkpoint: str, time_col: str = "Created", key: str = "MessageId",
                tolerance: str = LATE_TOLERANCE, max_batches: int = 10_000) -> dict[str, int]:
    """Archive everything available; returns the rows read, and of them the late and the repeated ones
    (over the last ``max_batches`` micro-batches of the run)."""
    spark = stream.sparkSession
    before = spark.conf.get(_KEPT_PROGRESS, None)
    spark.conf.set(_KEPT_PROGRESS, str(max_batches))
    try:
        q = (late_events(stream, time_col, key, tolerance).writeStream.format("json").option("path", out_path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        found = {"read": 0, "late": 0, "repeated": 0}
        for p in q.recentProgress:
            found["read"] += p["numInputRows"]
            for op in p["stateOperators"]:
                found["late"] += op["numRowsDroppedByWatermark"]
                found["repeated"] += op["customMetrics"].get("numDroppedDuplicateRows", 0)
    finally:
        if before is None:
            spark.conf.unset(_KEPT_PROGRESS)
        else:
            spark.conf.set(_KEPT_PROGRESS, before)
    return found
