"""Series and documents kept current equal the batch job after every micro-batch."""

import datetime as dt
import os
import random

import pytest

from tidewatch.operators import timeseries as ts
from tidewatch.sources import merge_table
from tidewatch.streaming import live_series as ls
from tidewatch.streaming.pipelines import message_stream

SCHEMA = "MessageId string, Created timestamp, Keywords array<string>, Sectors array<string>, Groups array<string>, Statuses array<string>"


def messages(month, n, seed):
    rng = random.Random(seed)
    pick = lambda m: rng.choice([None, [], [rng.choice("abcdefgh") for _ in range(rng.randint(1, m))]])
    rows = [(f"{seed}-{i}", dt.datetime(2024, month, rng.randint(1, 3), rng.randrange(24), 5), pick(4), None, pick(2), []) for i in range(n)]
    return rows + [("no-date", None, ["a"], None, None, None), ("empty", dt.datetime(2024, month, 1), None, None, None, None)]


def files(path):
    return {f"{at}/{f}": os.stat(f"{at}/{f}").st_mtime_ns for at, _, names in os.walk(path) for f in names if f.startswith("part")}


def read(spark, path):
    return sorted((r.name, r.value) for r in spark.read.text(path).collect())


def batch(spark, rows, path):
    from tidewatch.sources.messages import write_timeseries

    write_timeseries(ts.timeseries_documents(ts.timeseries_long(spark.createDataFrame(rows, SCHEMA))), path)
    return read(spark, path)


def run(spark, src, work, docs):
    stream = message_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, fmt="parquet", max_files_per_trigger=1)
    ls.run_live_series(spark, stream, work, docs, buckets=4)


def test_documents_equal_the_batch_job_after_every_batch(spark, tmp_path):
    src, work, docs, seen = f"{tmp_path}/in", f"{tmp_path}/work", f"{tmp_path}/docs", []
    before = {}
    for step, month in enumerate((1, 2, 1)):
        rows = messages(month, 60, step)
        seen += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        run(spark, src, work, docs)
        assert read(spark, docs) == batch(spark, seen, f"{tmp_path}/plain{step}")
        now = files(docs)
        if step == 2:  # January again: February's document is the file it was
            kept = [f for f in before if now.get(f) == before[f]]
            assert len(kept) == 1 and "02" in kept[0].split("name=")[1].split("/")[0]
        before = now


@pytest.mark.parametrize("stop", ["cube", "totals", "documents"])
def test_a_batch_run_again_after_a_crash_adds_nothing_twice(spark, tmp_path, monkeypatch, stop):
    src, work, docs = f"{tmp_path}/in", f"{tmp_path}/work", f"{tmp_path}/docs"
    rows = messages(3, 40, 9)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(src)
    plain = merge_table.merge

    def crash(*args, **kwargs):
        raise OSError("lost")

    def merge(spark_, path, *args, **kwargs):
        plain(spark_, path, *args, **kwargs)
        if path.endswith(stop):
            raise OSError("lost")

    with monkeypatch.context() as m:
        if stop == "documents":
            m.setattr(ls, "write_timeseries", crash)
        else:
            m.setattr(ls.merge_table, "merge", merge)
        with pytest.raises(Exception, match="lost"):
            run(spark, src, work, docs)
    run(spark, src, work, docs)
    assert read(spark, docs) == batch(spark, rows, f"{tmp_path}/plain")


def test_a_batch_writes_few_files_whatever_the_shuffle_partitions(spark, tmp_path):
    src, work, docs = f"{tmp_path}/in", f"{tmp_path}/work", f"{tmp_path}/docs"
    rows = messages(1, 200, 3)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(src)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        run(spark, src, work, docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for table in ("cube", "totals"):
        written = [f.rsplit("/", 1)[0] for f in files(f"{work}/{table}/data") if f.endswith(".parquet")]
        assert written and max(written.count(b) for b in written) <= spark.sparkContext.defaultParallelism
    assert read(spark, docs) == batch(spark, rows, f"{tmp_path}/plain")
