"""Structured Streaming jobs.

Batch and stream share the DataFrame functions of ``tidewatch.operators``.
Stateless per-message work runs directly on the stream; work that needs a
vocabulary-level lookup (tagging) or a table merge (user state) runs per
micro-batch in ``foreachBatch`` with the batch functions. Every query has its
own checkpoint location, so a restarted job resumes from committed offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.labels import SECTIONS
from tidewatch.functions.timeutil import hour_ms
from tidewatch.operators.common import FAST_GZIP

LATE_TOLERANCE = "10 seconds"


def message_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                   max_files_per_trigger: int | None = None, consume: bool = False,
                   max_bytes_per_trigger: int | None = None) -> DataFrame:
    """File-based micro-batch source; a batch is bounded by
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` (a Kafka source would use
    ``maxOffsetsPerTrigger``). With ``consume`` the folder is a queue of this one query: messages are
    deleted after success, the files of a batch once it is committed (those of
    a run's last batch may stay)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if consume:
        r = r.option("cleanSource", "delete")
    return r.load(path)


def late_events(stream: DataFrame, time_col: str = "Created", key: str = "MessageId",
                tolerance: str = LATE_TOLERANCE) -> DataFrame:
    """10 s out-of-order tolerance, policy drop, plus de-duplication of the
    at-least-once input on the message key (S17).

    A watermark only acts inside a stateful operator, here the de-duplication
    on the message key. Spark filters late rows against the watermark of the
    previous micro-batch, so a row counts as late once a batch has moved the
    watermark past it (checked on Spark 4.1).
    """
    return stream.withWatermark(time_col, tolerance).dropDuplicatesWithinWatermark([key])


def archive(stream: DataFrame, out_path: str, checkpoint: str, trigger_once: bool = True):
    """Pass-through archive of a stream to JSON files."""
    w = stream.writeStream.format("json").option("path", out_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def hourly_stream(stream: DataFrame, tolerance: str = LATE_TOLERANCE) -> DataFrame:
    """The hourly cube kept current as messages arrive.

    (window hour, section, value) → records, occurrences, with a watermark so
    closed hours are emitted in append mode and their state is dropped.
    """
    def tag(c: str):
        return lambda v, i: F.struct(
            F.lit(c).alias("section"), v.alias("value"),
            (F.array_position(F.coalesce(F.col(c), F.array()), v) == i + 1).alias("first"),
        )

    parts = [F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), tag(c)) for c in SECTIONS]
    entries = stream.filter(F.col("Created").isNotNull()).select("Created", F.inline(F.concat(*parts)))
    entries = entries.filter(F.col("value").isNotNull())
    return (
        entries.withWatermark("Created", tolerance)
        .groupBy(F.window("Created", "1 hour").alias("w"), "section", "value")
        .agg(F.count(F.lit(1)).alias("occurrences"), F.count_if("first").alias("records"))
        .select(hour_ms(F.col("w.start")).alias("hour_ms"), "section", "value", "occurrences", "records")
    )


def run_available_now(df: DataFrame, out_path: str, checkpoint: str, mode: str = "append",
                      fmt: str = "parquet") -> None:
    """Drain everything available (replaces the weekly batch run) and stop."""
    q = (df.writeStream.format(fmt).outputMode(mode).option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def foreach_batch_available_now(df: DataFrame, fn, checkpoint: str, mode: str = "append") -> None:
    q = (df.writeStream.foreachBatch(fn).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def run_update_to_table(df: DataFrame, out_path: str, checkpoint: str) -> None:
    """Aggregates in update mode: every micro-batch appends the rows it
    changed, stamped with the batch id; ``latest_rows`` reads the current
    value per key. Open windows are visible before the watermark closes them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch, overwritten if the batch is retried (idempotent)
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    foreach_batch_available_now(df, write, checkpoint, mode="update")


def latest_rows(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Current value per key of an update-mode table (largest batch id)."""
    vals = [c for c in versions.columns if c not in keys and c != "batch_id"]
    return versions.groupBy(*keys).agg(
        F.max_by(F.struct(*vals), "batch_id").alias("_v")
    ).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])


def write_queue(rows: DataFrame, path: str) -> None:
    """A queue folder of one micro-batch: JSON lines in gzip files, overwritten on a retry."""
    rows.write.mode("overwrite").options(**FAST_GZIP).json(path)


def fan_out(stream: DataFrame, table_path: str, graph_path: str, pipeline_path: str, checkpoint: str) -> None:
    """Each raw tweet goes to the tweet table (S9 insert-only), to the
    user-graph queue (flat row) and to the pipeline queue (envelope), once
    per micro-batch with the batch persisted while it is written three ways
    (the queues as gzip files)."""
    from tidewatch.sources.tweets import tweet_envelope, tweet_row, write_tweets

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        b = batch.persist()
        rows = tweet_row(b)
        write_tweets(spark, rows, table_path)  # insert-only: a retried batch adds nothing
        write_queue(rows, f"{graph_path}/batch_id={batch_id}")
        write_queue(tweet_envelope(b), f"{pipeline_path}/batch_id={batch_id}")
        b.unpersist()

    foreach_batch_available_now(stream, write, checkpoint)


def tag_stream(stream: DataFrame, keywords: DataFrame, categories: DataFrame | None, out_path: str,
               checkpoint: str, gazetteer: DataFrame | None = None, users: DataFrame | None = None,
               geo_order: str = "latlon", keyword_path: str | None = None, sentence_path: str | None = None,
               **tag_args) -> None:
    """Streaming tagging; each micro-batch is tagged with the batch
    operator (dictionaries are static DataFrames) and, with a ``gazetteer``,
    located by the J8 cascade. Besides the tagged messages it can feed the two
    S14 sinks, JSON rows partitioned by source: every keyword row
    (``keyword_path``) and the sentence rows that pass P12 (``sentence_path``).
    Each batch writes folders of its own, overwritten on a retry."""
    from tidewatch.operators.common import cut_lineage
    from tidewatch.operators.locate import resolve_locations
    from tidewatch.operators.tagging import emit_sentence, keyword_messages, tag_messages
    from tidewatch.sources.messages import write_json_sink

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_messages(batch, keywords, categories, **tag_args)
        if gazetteer is not None:
            tagged = resolve_locations(tagged, gazetteer, users, geo_order)
        tagged = cut_lineage(tagged)  # written up to three ways
        columns = ["MessageId", "Source", "Language", "Keywords", "Groups"]
        columns += ["Locations"] if gazetteer is not None else []
        tagged.select(*columns).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        if keyword_path:
            write_json_sink(keyword_messages(tagged), f"{keyword_path}/batch_id={batch_id}", mode="overwrite")
        if sentence_path:
            kept = [c for c in ("MessageId", "Source", "Sentence", "Language", "Created", "Keywords", "Groups", "Locations") if c in tagged.columns]
            write_json_sink(emit_sentence(tagged).select(*kept), f"{sentence_path}/batch_id={batch_id}", mode="overwrite")

    foreach_batch_available_now(stream, write, checkpoint)


def user_state_stream(stream: DataFrame, state_path: str, checkpoint: str) -> None:
    """Running user state. Each micro-batch's observations are condensed
    (A5) and merged into the stored condensed table (occurrences add up); the
    new version is written next to the old one and becomes current by its batch
    id once the batch is committed (a retried batch overwrites its own folder).
    The state is one row per distinct location of a user and is rewritten per
    batch. Users are the A6 centre of the current version."""
    from tidewatch.operators.graph import condense_locations, point_observations

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = condense_locations(point_observations(batch))
        cur = _latest_version(spark, state_path, before=batch_id)  # a retry re-merges onto the same base
        if cur is not None:
            merged = cur.unionByName(new).groupBy("user_id", "kind", "key").agg(
                F.sum("occurrences").alias("occurrences"), F.first("lat").alias("lat"), F.first("lon").alias("lon")
            )
        else:
            merged = new
        merged.write.mode("overwrite").parquet(f"{state_path}/v={batch_id:012d}")

    foreach_batch_available_now(stream, write, checkpoint)


def _latest_version(spark: SparkSession, state_path: str, before: int | None = None) -> DataFrame | None:
    """Highest committed version folder ``v=...`` of the state table
    (strictly below ``before`` when given)."""
    from pyspark.errors import AnalysisException

    try:
        versions = spark.read.parquet(state_path)
    except AnalysisException:
        return None
    if before is not None:
        versions = versions.filter(F.col("v") < before)
    top = versions.agg(F.max("v").alias("v")).first()["v"]
    if top is None:
        return None
    return versions.filter(F.col("v") == top).drop("v")


def current_users(spark: SparkSession, state_path: str) -> DataFrame:
    from tidewatch.operators.graph import user_centroid

    return user_centroid(_latest_version(spark, state_path))


def user_centroid_stream(points: DataFrame) -> DataFrame:
    """T3, stateful variant with built-in operators: each user's distinct
    points are de-duplicated in the state store, then a running sum of unit
    vectors per user is kept (update mode). The first state holds every distinct
    point for ever, which exact de-duplication without a time limit needs. Finish with
    ``functions.geo.centre_from_vector``. Both states are keyed (user, point)
    and user, so a hot user is summed incrementally, never held as a list."""
    from tidewatch.functions.geo import centre_aggs

    distinct_pts = points.dropDuplicates(["user_id", "lat", "lon"])
    return distinct_pts.groupBy("user_id").agg(*centre_aggs("lat", "lon"))
