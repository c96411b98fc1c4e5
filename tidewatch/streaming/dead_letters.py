"""Bad input and failing messages on streams (S2, S10, S17): dead letters and bounded retries.

A queue consumer that throws gets its message again, a fixed number of times,
and then the message goes to a poison queue. Here that is two queries with
checkpoints of their own:

* ``deliver`` reads new lines and redelivered ones, judges each line (corrupt
  records, missing keys, a caller's own test) and hands the good ones to a
  writer. Lines that fail for a reason that no retry mends are dead letters at
  once, the others are written down as failures. It is stateless, so neither
  good nor malformed messages cost state or Python.
* ``settle`` reads the failures and counts the attempts of each message in
  keyed state (``transformWithState``): below the limit the line goes to the
  retry folder, which ``deliver`` reads as a second source; at the limit it goes
  to the dead letters.

Every attempt carries its number, and the state ignores a number it has seen,
so a batch that is run again counts once; equal lines under retry are one
message. State is dropped as soon as a message is dead or has got through.
Folders are written per batch in overwrite mode, so a batch that is run again
leaves the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.streaming.pipelines import foreach_batch_available_now, message_stream, write_queue

CORRUPT = "_corrupt"
#: Reasons that lie in the line itself: another attempt ends alike.
PERMANENT = ("empty", "malformed")
MAX_ATTEMPTS = 5
FAILURE = "key string, line string, reason string, attempt int"
RETRY = "line string, attempt int"


@contextmanager
def state_store(spark: SparkSession, partitions: int | None = None):
    """Settings that ``transformWithState`` asks for while a query starts and runs: the RocksDB state
    store and, for a new checkpoint, the number of state partitions (else that of shuffles)."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ensure_folder(spark: SparkSession, path: str) -> str:
    """Create ``path`` in its file system: a file stream wants its folder to exist."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
    return path


def line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, **source) -> DataFrame:
    """Text lines as they arrive, with the number of their attempt (1); ``source`` as in ``message_stream``."""
    lines = message_stream(spark, path, T.StructType().add("value", "string"), "text", max_files_per_trigger, **source)
    return lines.select(F.col("value").alias("line"), F.lit(1).alias("attempt"))


def redelivered(spark: SparkSession, path: str) -> DataFrame:
    """Lines that ``settle`` sent back."""
    return spark.readStream.schema(RETRY).json(ensure_folder(spark, path)).select("line", "attempt")


def parse_records(lines: DataFrame, schema: T.StructType | str, required: dict[str, Column] | None = None,
                  control: Column | None = None) -> DataFrame:
    """S2 on a batch or a stream: (line, attempt, record, reason).

    ``reason`` is null for a good record, else ``empty``, ``malformed`` (no JSON
    object of this schema) or the first name in ``required`` whose condition on
    the record (columns ``record.*``) doesn't hold. Records for which ``control``
    holds are exempt from ``required``; a writer drops them by itself.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    wide = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    j = F.from_json("line", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = lines.withColumn("record", j)
    bad = F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()
    reason = F.when(F.trim(F.coalesce("line", F.lit(""))) == "", F.lit("empty")).when(bad, F.lit("malformed"))
    for name, holds in (required or {}).items():
        exempt = F.coalesce(control, F.lit(False)) if control is not None else F.lit(False)
        reason = reason.when(~F.coalesce(holds, F.lit(False)) & ~exempt, F.lit(name))
    return parsed.withColumn("reason", reason)


def message_key(line: str = "line") -> Column:
    """What a message is counted under: its text."""
    return F.sha2(F.coalesce(F.col(line), F.lit("")), 256)


def failures_of(judged: DataFrame, permanent: tuple[str, ...]) -> DataFrame:
    """Lines to try again, and redelivered ones that are settled (reason null): rows of FAILURE."""
    reason = F.when(~F.col("reason").isin(*permanent), F.col("reason"))
    return judged.select(message_key().alias("key"), "line", reason.alias("reason"), "attempt").filter(
        F.col("reason").isNotNull() | (F.col("attempt") > 1))


def deliver(lines: DataFrame, judge: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None],
            failures_path: str, dead_path: str, checkpoint: str, permanent: tuple[str, ...] = PERMANENT) -> None:
    """One run over what is available: ``judge`` adds ``record`` and ``reason`` to (line, attempt),
    ``write`` gets the good records of a micro-batch, the others are written down."""
    def each(batch: DataFrame, batch_id: int) -> None:
        # Judged once and kept while it is written; a good record needs no line any more, a bad line no record.
        ok = F.col("reason").isNull()
        judged = judge(batch).withColumn("record", F.when(ok, F.col("record"))).withColumn(
            "line", F.when(~ok | (F.col("attempt") > 1), F.col("line"))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(judged.filter(ok).select("record.*").drop(CORRUPT), batch_id)
            final = judged.filter(F.col("reason").isin(*permanent)).select("reason", "line", "attempt")
            write_queue(final, f"{dead_path}/by=deliver/batch_id={batch_id}")
            failures_of(judged, permanent).write.mode("overwrite").json(f"{failures_path}/batch_id={batch_id}")
        finally:
            judged.unpersist()

    foreach_batch_available_now(lines, each, checkpoint)


def attempts_processor(max_attempts: int):
    """Counts the attempts of a message: state (attempt), rows (line, reason, attempt, verdict).

    For ``transformWithState``, whose rows come one by one, as a message has one or two in a
    micro-batch; pandas tables, as ``transformWithStateInPandas`` hands them out, are answered alike."""
    import pandas as pd
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    columns = ["line", "reason", "attempt", "verdict"]

    class Attempts(StatefulProcessor):
        def init(self, handle) -> None:
            self.seen = handle.getValueState("seen", "attempt int")

        def handleInputRows(self, key, rows, timer_values) -> Iterator[Row | pd.DataFrame]:  # noqa: N802
            given, tables = [], False
            for r in rows:
                if tables := isinstance(r, pd.DataFrame):
                    given += [(a, None if pd.isna(b) else b, c) for a, b, c in r[columns[:3]].itertuples(index=False)]
                else:
                    given.append((r["line"], r["reason"], r["attempt"]))
            held = self.seen.get()
            seen = held[0] if held else 0
            out, settled = [], False
            for line, reason, attempt in sorted(given, key=lambda x: x[2]):
                if reason is None:
                    settled = True  # a later attempt ended it
                elif attempt > seen:
                    seen = int(attempt)
                    dead = seen >= max_attempts
                    settled |= dead
                    out.append((line, reason, seen, "dead" if dead else "retry"))
            if settled:
                if held:
                    self.seen.clear()
            else:
                self.seen.update((seen,))
            if tables and out:
                yield pd.DataFrame(out, columns=columns)
            elif not tables:
                yield from (Row(**dict(zip(columns, x, strict=True))) for x in out)

        def close(self) -> None:
            pass

    return Attempts()


def settle(spark: SparkSession, failures_path: str, retry_path: str, dead_path: str, checkpoint: str,
           max_attempts: int = MAX_ATTEMPTS, state_partitions: int | None = None) -> int:
    """One run over the failures written so far: to the retry folder or to the dead letters.
    Returns the number of lines sent back."""
    sent = []

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        back = batch.filter("verdict = 'retry'").select("line", (F.col("attempt") + 1).alias("attempt"))
        back.write.mode("overwrite").json(f"{retry_path}/batch_id={batch_id}")
        write_queue(batch.filter("verdict = 'dead'").select("reason", "line", "attempt"), f"{dead_path}/by=settle/batch_id={batch_id}")
        sent.append(back.count())
        batch.unpersist()

    ensure_folder(spark, failures_path)
    with state_store(spark, state_partitions):
        failures = spark.readStream.schema(FAILURE).json(failures_path).select("key", "line", "reason", "attempt")
        judged = failures.groupBy("key").transformWithState(
            statefulProcessor=attempts_processor(max_attempts),
            outputStructType="line string, reason string, attempt int, verdict string", outputMode="Update", timeMode="None")
        foreach_batch_available_now(judged, each, checkpoint, mode="update")
    return sum(sent)


def drain(spark: SparkSession, source: str, judge: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None],
          root: str, max_attempts: int = MAX_ATTEMPTS, permanent: tuple[str, ...] = PERMANENT,
          max_files_per_trigger: int | None = None, rounds: int | None = None, state_partitions: int | None = None,
          **source_options) -> DataFrame:
    """``deliver`` and ``settle`` in turn until nothing is sent back or after ``rounds`` of it;
    returns the dead letters (reason, line, attempt). A continuous job runs both queries side by side.
    All folders are under ``root``; a later call goes on from their checkpoints. ``source_options`` as in ``message_stream``."""
    failures, retry, dead = (f"{root}/{x}" for x in ("failures", "retry", "dead"))
    for _ in range(rounds or max_attempts):
        lines = line_stream(spark, source, max_files_per_trigger, **source_options).unionByName(redelivered(spark, retry))
        deliver(lines, judge, write, failures, dead, f"{root}/deliver-checkpoint", permanent)
        if not settle(spark, failures, retry, dead, f"{root}/settle-checkpoint", max_attempts, state_partitions):
            break
    return dead_letters(spark, dead)


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters written so far."""
    return spark.read.schema("reason string, line string, attempt int, by string, batch_id long").json(
        ensure_folder(spark, path)).select("reason", "line", "attempt")


# ------------------------------------------------------------- jobs on lines

#: What a raw tweet must hold to be stored: the keys of its row.
TWEET_KEYS = ("missing_id", "missing_time", "missing_user")


def tweet_judge(lines: DataFrame) -> DataFrame:
    """Raw tweet lines: JSON with id, time and user; rate-limit notices pass (P5 drops them)."""
    from tidewatch.schema import RAW_TWEET

    held = (F.col("record.id"), F.col("record.timestamp_ms").try_cast("long"), F.col("record.user.id"))
    required = {k: c.isNotNull() for k, c in zip(TWEET_KEYS, held, strict=True)}
    return parse_records(lines, RAW_TWEET, required, F.col("record.limit").isNotNull())


def fan_out_lines(spark: SparkSession, source: str, root: str, table_path: str, graph_path: str, pipeline_path: str,
                  max_attempts: int = MAX_ATTEMPTS, max_files_per_trigger: int | None = None, state_partitions: int | None = None,
                  **source_options) -> DataFrame:
    """S10 on raw lines: good tweets to the table and both queues, bad lines to the dead letters, which are returned.
    Missing keys can't come by waiting, so they are final like malformed lines."""
    from tidewatch.sources.tweets import tweet_envelope, tweet_row, write_tweets

    def write(good: DataFrame, batch_id: int) -> None:
        rows = tweet_row(good)
        write_tweets(spark, rows, table_path)
        write_queue(rows, f"{graph_path}/batch_id={batch_id}")
        write_queue(tweet_envelope(good), f"{pipeline_path}/batch_id={batch_id}")

    return drain(spark, source, tweet_judge, write, root, max_attempts, (*PERMANENT, *TWEET_KEYS), max_files_per_trigger,
                 state_partitions=state_partitions, **source_options)


def tag_lines(spark: SparkSession, source: str, root: str, keywords: Callable[[], DataFrame], categories: DataFrame | None, out_path: str,
              max_attempts: int = MAX_ATTEMPTS, max_files_per_trigger: int | None = None, rounds: int | None = None,
              state_partitions: int | None = None, **tag_args) -> DataFrame:
    """T2 on raw envelope lines: tagged messages go to ``out_path``; returns the dead letters.

    A message in a language without a dictionary fails with ``no_dictionary`` and
    is tried again: ``keywords`` is asked anew in every micro-batch, so a
    dictionary loaded meanwhile lets it through.
    """
    from tidewatch.operators.common import cut_lineage
    from tidewatch.operators.tagging import tag_messages
    from tidewatch.schema import ENVELOPES

    def judge(lines: DataFrame) -> DataFrame:
        judged = parse_records(lines, ENVELOPES, {"missing_id": F.col("record.message.id").isNotNull()})
        known = keywords().select(F.col("lang").alias("_lang")).distinct()  # one row a language
        lang = F.when(F.col("record.message.lang") == "in", F.lit("id")).otherwise(F.col("record.message.lang"))
        joined = judged.join(F.broadcast(known), lang == F.col("_lang"), "left")
        reason = F.coalesce(F.col("reason"), F.when(F.col("_lang").isNull(), F.lit("no_dictionary")))
        return joined.withColumn("reason", reason).drop("_lang")

    def write(good: DataFrame, batch_id: int) -> None:
        tagged = cut_lineage(tag_messages(good, keywords(), categories, **tag_args))
        tagged.select("MessageId", "Source", "Language", "Keywords", "Groups").write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return drain(spark, source, judge, write, root, max_attempts, (*PERMANENT, "missing_id"), max_files_per_trigger, rounds, state_partitions)
