"""Dead letters and bounded retries on streams."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.streaming import dead_letters as dl


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(line + "\n" for line in lines))


def judge_by(known):
    """Records whose topic is in ``known`` are good; others fail and may be tried again."""
    def judge(lines):
        parsed = dl.parse_records(lines, "id long, topic string", {"missing_id": F.col("record.id").isNotNull()})
        late = F.when(~F.coalesce(F.col("record.topic"), F.lit("")).isin(*known), F.lit("unknown_topic"))
        return parsed.withColumn("reason", F.coalesce("reason", late))
    return judge


def test_retries_are_bounded_and_go_on_after_a_restart(spark, tmp_path):
    src, root, out = f"{tmp_path}/in", f"{tmp_path}/work", f"{tmp_path}/out"
    rows = [{"id": i, "topic": "abc"[i % 3]} for i in range(12)]
    write_lines(src, "a.txt", [json.dumps(r) for r in rows] + ["prose", "", "  ", '{"id": 3', '{"topic": "a"}', "prose"])

    def write(good, batch_id):
        good.write.mode("overwrite").json(f"{out}/batch_id={batch_id}")

    permanent = (*dl.PERMANENT, "missing_id")
    got = lambda: sorted(r.id for r in spark.read.schema("id long").json(out).collect())
    args = {"max_attempts": 4, "permanent": permanent}
    dead = dl.drain(spark, src, judge_by(["a"]), write, root, rounds=2, **args)
    assert got() == [0, 3, 6, 9]
    kept = sorted((r.reason, r.line, r.attempt) for r in dead.collect())
    assert kept == sorted([("malformed", "prose", 1)] * 2 + [("empty", "", 1), ("empty", "  ", 1), ("malformed", '{"id": 3', 1),
                                                            ("missing_id", '{"topic": "a"}', 1)])
    # The next run knows topic b; a new file arrives; topic c reaches its limit.
    write_lines(src, "b.txt", [json.dumps({"id": 50, "topic": "a"}), json.dumps(rows[2])])
    dead = dl.drain(spark, src, judge_by(["a", "b"]), write, root, **args)
    assert got() == sorted([0, 3, 6, 9, 1, 4, 7, 10, 50])
    lost = sorted((json.loads(r.line)["id"], r.attempt) for r in dead.filter("reason = 'unknown_topic'").collect())
    assert lost == [(i, 4) for i in (2, 5, 8, 11)]
    # Nothing is left over: another run changes neither.
    before = got(), dead.count()
    again = dl.drain(spark, src, judge_by(["a", "b"]), write, root, **args)
    assert (got(), again.count()) == before


class Value:
    """A value state in memory."""

    def __init__(self):
        self.row = None

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None


def attempts(max_attempts):
    p = dl.attempts_processor(max_attempts)
    p.seen = Value()

    def feed(*rows):
        table = pd.DataFrame([("x", *r) for r in rows], columns=["line", "reason", "attempt"])
        return [tuple(r)[1:] for out in p.handleInputRows(("k",), iter([table]), None) for r in out.itertuples(index=False)]

    return p, feed


def test_an_attempt_that_comes_twice_counts_once():
    p, feed = attempts(3)
    assert feed(("late", 1), ("late", 1)) == [("late", 1, "retry")]
    assert feed(("late", 1)) == []  # the batch was run again
    assert feed(("late", 2)) == [("late", 2, "retry")]
    assert feed(("late", 3)) == [("late", 3, "dead")] and not p.seen.exists()


def test_state_goes_when_a_message_gets_through():
    p, feed = attempts(3)
    feed(("late", 1))
    assert p.seen.exists()
    assert feed((None, 2)) == [] and not p.seen.exists()


@pytest.mark.parametrize("line,reason", [
    (None, "empty"), ("", "empty"), ("   ", "empty"), ("x", "malformed"), ("[1]", "malformed"), ('{"id": "x"}', "malformed"),
    ("{}", "missing_id"), ('{"id": null, "topic": "a"}', "missing_id"), ('{"id": 1}', None), ('{"id": 1, "more": 2}', None),
])
def test_reasons(spark, line, reason):
    lines = spark.createDataFrame([(line, 1)], "line string, attempt int")
    got = dl.parse_records(lines, "id long, topic string", {"missing_id": F.col("record.id").isNotNull()}).first()
    assert got.reason == reason


def test_fan_out_keeps_bad_lines_out_of_the_table(spark, tmp_path):
    src, root = f"{tmp_path}/in", f"{tmp_path}/w"
    tweet = {"id": 7, "timestamp_ms": "86400000", "user": {"id": 1, "screen_name": "a"}, "text": "t"}
    lines = [json.dumps(tweet), json.dumps(tweet), "not json at all", json.dumps({"limit": {"track": 3}}),
             json.dumps({**tweet, "timestamp_ms": "x"}), json.dumps({k: v for k, v in tweet.items() if k != "user"})]
    write_lines(src, "a.txt", lines)
    dead = dl.fan_out_lines(spark, src, root, *(f"{tmp_path}/{x}" for x in ("t", "g", "p")))
    assert sorted(r.reason for r in dead.collect()) == ["malformed", "missing_time", "missing_user"]
    assert [(r.epoch_day, r.id) for r in spark.read.parquet(f"{tmp_path}/t").collect()] == [(1, 7)]
    assert spark.read.json(f"{tmp_path}/g").count() == 2 and spark.read.json(f"{tmp_path}/p").count() == 2


def test_consumed_lines_go_once_they_are_stored_and_none_is_lost(spark, tmp_path):
    src, root = f"{tmp_path}/in", f"{tmp_path}/w"
    paths = [f"{tmp_path}/{x}" for x in ("t", "g", "p")]

    def tweet(i):
        return json.dumps({"id": i, "timestamp_ms": "86400000", "user": {"id": 1, "screen_name": "a"}, "text": f"t{i}"})

    def left():
        return [n for n in os.listdir(src) if not n.startswith(".")]

    def ids(*formats):
        return [sorted(r.id for r in spark.read.format(f).load(p).selectExpr(f"cast({c} as long) as id").collect())
                for p, f, c in zip(paths, formats, ("id", "id", "message.id"), strict=True)]

    for i in range(4):
        write_lines(src, f"{i}.txt", [tweet(i), tweet(10 + i), f"prose {i}"])
    args = {"max_files_per_trigger": 1, "consume": True}
    dead = dl.fan_out_lines(spark, src, root, *paths, **args)
    assert ids("parquet", "json", "json") == [[0, 1, 2, 3, 10, 11, 12, 13]] * 3
    assert sorted(r.line for r in dead.collect()) == [f"prose {i}" for i in range(4)]
    assert len(left()) <= 1  # the files of the last micro-batch may stay
    found = [f"{d}/{n}" for d, _, names in os.walk(f"{root}/dead") for n in names if n.startswith("part-")]
    assert found and all(n.endswith(".json.gz") for n in found)
    # A later run takes what is new and nothing twice.
    write_lines(src, "9.txt", [tweet(20), "prose 9"])
    dead = dl.fan_out_lines(spark, src, root, *paths, **args)
    assert ids("parquet", "json", "json") == [[0, 1, 2, 3, 10, 11, 12, 13, 20]] * 3 and dead.count() == 5


def test_a_first_batch_without_a_good_line(spark, tmp_path):
    src, root = f"{tmp_path}/in", f"{tmp_path}/w"
    paths = [f"{tmp_path}/{x}" for x in ("t", "g", "p")]
    write_lines(src, "0.txt", ["prose"])
    assert dl.fan_out_lines(spark, src, root, *paths, max_files_per_trigger=1).count() == 1
    write_lines(src, "1.txt", [json.dumps({"id": 5, "timestamp_ms": "1", "user": {"id": 1}})])
    assert dl.fan_out_lines(spark, src, root, *paths, max_files_per_trigger=1).count() == 1
    assert [(r.epoch_day, r.id) for r in spark.read.parquet(paths[0]).collect()] == [(0, 5)]


def test_a_folder_is_kept_unless_it_is_a_queue(spark, tmp_path):
    src, root = f"{tmp_path}/in", f"{tmp_path}/w"
    for i in range(3):
        write_lines(src, f"{i}.txt", [f"prose {i}"])
    dead = dl.fan_out_lines(spark, src, root, *(f"{tmp_path}/{x}" for x in ("t", "g", "p")), max_files_per_trigger=1)
    assert dead.count() == 3 and len([n for n in os.listdir(src) if not n.startswith(".")]) == 3


def test_packed_lines_are_bounded_files_without_a_shuffle(spark, monkeypatch):
    from tidewatch.plans import fixtures as fx

    lines = spark.range(0, 100, 1, 2).selectExpr("concat('line ', id) as value")
    shuffles = []
    monkeypatch.setattr(type(lines), "repartition", lambda self, *a: shuffles.append(a) or self)
    path = fx.packed_lines(spark, lines, "packed", 20)
    sizes = {r.name: r.length for r in fx.file_sizes(spark, path).collect()}
    assert not shuffles and len(sizes) == 6 and all(n.endswith(".txt.gz") for n in sizes)  # 50 lines a task: 20, 20, 10
    rows = spark.read.text(path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in rows) == 20 and sum(r["count"] for r in rows) == 100
    assert fx.written_parts(spark, path) == 2
    total, most = sum(sizes.values()), max(sizes.values())
    assert total / 3 < fx.batch_bytes(spark, path, 3) <= total / 3 + most / 2 + 2
    assert fx.batch_bytes(spark, path, 2, but=total) <= most / 2 + 1
    even = spark.range(0, 4, 1, 2).selectExpr("'line' as value")  # two files of one size are two batches of one file
    two = fx.packed_lines(spark, even, "packed", 20)
    size = fx.total_bytes(spark, two) // 2
    assert size < fx.batch_bytes(spark, two, 2) < 2 * size
