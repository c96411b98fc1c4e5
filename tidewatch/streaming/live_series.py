"""Hourly series and their documents kept current as messages arrive.

Incremental view maintenance over the tables of the trend job:

1. a micro-batch is aggregated to a cube delta (hour, section, value);
2. the delta is added to the stored cube, and, per span, to the stored totals;
3. the spans of the delta's hours are the touched ones: their entries are ranked
   from the totals, their series read from the cube, and their documents
   rewritten by dynamic partition overwrite. Other spans stay untouched.

Messages are read once; later steps read aggregated tables only. Both tables
are versioned merge tables and take the batch's number as token, and documents
are made from the tables, so a batch that is run again after a crash at any
point adds nothing twice and leaves the same documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.labels import section_label
from tidewatch.operators import timeseries as ts
from tidewatch.operators.common import checkpointed
from tidewatch.sources import merge_table
from tidewatch.sources.messages import write_timeseries
from tidewatch.streaming.pipelines import foreach_batch_available_now

MEASURES = ("occurrences", "records")


def touched_documents(spark: SparkSession, work: str, delta: DataFrame, k: int = ts.DEFAULT_K, levels=ts.JOB_LEVELS) -> DataFrame:
    """Documents of the spans that hold an hour of ``delta``, from the stored cube and totals."""
    spans = F.broadcast(ts.distinct_timespans(ts.span_cube(delta, levels)))  # the calendar of a batch
    totals = merge_table.read_table(spark, f"{work}/totals").join(spans, "timespan", "left_semi")
    top = ts.topk_per_timespan(totals, k)
    cube = ts.span_cube(merge_table.read_table(spark, f"{work}/cube"), levels).join(spans, "timespan", "left_semi")
    hourly = ts.hourly_counts(cube, top, k)
    return ts.timeseries_documents(hourly.select("timespan", "hour_ms", "rank", section_label("section", "value").alias("label"), "n"))


def run_live_series(spark: SparkSession, messages: DataFrame, work: str, documents: str, k: int = ts.DEFAULT_K, levels=ts.JOB_LEVELS,
                    buckets: int = merge_table.BUCKETS) -> None:
    """Drain the stream of messages into the tables under ``work`` and the documents (S16) at ``documents``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # deltas are small beside the batch: in few parts, so that a merge writes few files for each bucket
        delta = checkpointed(ts.hour_cube(batch))
        if delta.isEmpty():
            return
        merge_table.merge(spark, f"{work}/cube", delta, ["hour", "section", "value"], token=batch_id, buckets=buckets, add=MEASURES)
        by_span = checkpointed(ts.span_counts(ts.span_cube(delta, levels)))
        merge_table.merge(spark, f"{work}/totals", by_span, ["timespan", "section", "value"], token=batch_id, buckets=buckets, add=MEASURES)
        write_timeseries(touched_documents(spark, work, delta, k, levels), documents, only_spans=True)

    foreach_batch_available_now(messages, write, f"{work}/checkpoint")
