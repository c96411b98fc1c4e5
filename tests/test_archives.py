"""Late policy of the archives over several micro-batches and a restart."""

import datetime as dt

from tidewatch.streaming import archives
from tidewatch.streaming.pipelines import message_stream

SCHEMA = "MessageId string, Created timestamp, Sentence string"


def at(seconds):
    return dt.datetime(2024, 5, 1) + dt.timedelta(seconds=seconds)


def test_late_and_repeated_rows_are_left_out_and_counted(spark, tmp_path):
    src, out, ck = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck"

    def arrive(*rows):
        spark.createDataFrame([(k, at(t), "s") for k, t in rows], SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = message_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, fmt="parquet", max_files_per_trigger=1)
        return archives.run_archive(stream, out, ck)

    arrive(("1", 100), ("2", 104), ("2", 104))
    arrive(("3", 200), ("4", 96))  # 8 s out of order: kept
    assert run() == {"read": 5, "late": 0, "repeated": 1}
    arrive(("5", 300), ("6", 20), ("7", 205), ("3", 201))
    found = run()  # the state and its watermark outlive the restart
    assert found["read"] == 4 and (found["late"], found["repeated"]) == (1, 1)
    assert sorted(r.MessageId for r in spark.read.json(out).collect()) == ["1", "2", "3", "4", "5", "7"]
    assert run()["read"] == 0
