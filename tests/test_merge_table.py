"""Versioned merge table and the live user state that is kept in it."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import graph as gr
from tidewatch.sources import merge_table as mt
from tidewatch.streaming import user_state as us
from tidewatch.streaming.pipelines import message_stream


def users(spark, rows):
    return spark.createDataFrame(rows, "user_id string, a long, b string")


def stored(spark, path, version=None):
    return sorted(map(tuple, mt.read_table(spark, path, version).collect()))


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_merges_equal_a_plain_version(spark, tmp_path, limit):
    rng, path, plain = random.Random(limit), f"{tmp_path}/t", {}
    assert mt.read_table(spark, path) is None
    for step in range(4):
        new = {f"u{rng.randrange(60)}": (rng.choice([None, rng.randrange(9)]), rng.choice([None, "x", "y"])) for _ in range(25)}
        rows = [(k, *v) for k, v in new.items()] + [(None, 1, "lost")]
        mt.merge(spark, path, users(spark, rows), ["user_id"], token=step, buckets=7, broadcast_bytes=limit)
        for k, v in new.items():
            old = plain.get(k, (None, None))
            plain[k] = tuple(o if x is None else x for x, o in zip(v, old, strict=True))
        assert stored(spark, path) == sorted((k, *v) for k, v in plain.items())


def test_a_repeated_token_is_applied_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    mt.merge(spark, path, users(spark, [("u", 1, "x")]), ["user_id"], token=4)
    assert mt.merge(spark, path, users(spark, [("u", 2, "y")]), ["user_id"], token=4) == 0
    assert stored(spark, path) == [("u", 1, "x")]
    assert mt.merge(spark, path, users(spark, [("u", None, "y")]), ["user_id"], token=5, fill=False) == 1
    assert stored(spark, path) == [("u", None, "y")]


def test_a_crash_before_the_manifest_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    mt.merge(spark, path, users(spark, [(f"u{i}", i, "x") for i in range(30)]), ["user_id"], buckets=4)
    before = stored(spark, path)
    with monkeypatch.context() as m:
        m.setattr(mt._Files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            mt.merge(spark, path, users(spark, [("u1", 99, "z"), ("new", 1, "z")]), ["user_id"])
    assert os.path.isdir(f"{path}/data/v=1") and stored(spark, path) == before
    mt.merge(spark, path, users(spark, [("u2", 98, None)]), ["user_id"])
    assert stored(spark, path) == sorted([r for r in before if r[0] != "u2"] + [("u2", 98, "x")])


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    mt.merge(spark, path, users(spark, [("u", 1, "x")]), ["user_id"])
    with pytest.raises(RuntimeError):
        mt._Files(spark, path).publish("manifests/000000000000.json", "{}")


def test_only_touched_buckets_are_rewritten_and_old_ones_removed(spark, tmp_path):
    path = f"{tmp_path}/t"
    mt.merge(spark, path, users(spark, [(f"u{i}", i, "x") for i in range(200)]), ["user_id"], buckets=16)
    for i in range(5):
        mt.merge(spark, path, users(spark, [("u3", 1000 + i, None)]), ["user_id"])
    m = mt.manifest(spark, path)
    assert m["version"] == 5 and sorted(set(m["at"].values())) == [0, 5] and len([v for v in m["at"].values() if v == 5]) == 1
    assert sorted(os.listdir(f"{path}/data")) == ["v=0", "v=4", "v=5"]
    assert sorted(n for n in os.listdir(f"{path}/manifests") if n.endswith(".json") and n[0] != ".") == ["000000000004.json", "000000000005.json"]
    assert len(stored(spark, path)) == 200 and dict(r[:2] for r in stored(spark, path))["u3"] == 1004
    assert dict(r[:2] for r in stored(spark, path, 4))["u3"] == 1003


def test_a_small_merge_does_not_shuffle_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    mt.merge(spark, path, users(spark, [(f"u{i}", i, "x") for i in range(1000)]), ["user_id"], buckets=4)
    old, new = mt.read_table(spark, path), users(spark, [(f"u{i}", 0, "y") for i in range(0, 1000, 100)])
    plan = mt.merge_rows(old, new, ["user_id"], True, True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastExchange" in plan


def tweet_rows():
    rng, rows = random.Random(3), []
    for i in range(400):
        geo = json.dumps({"type": "Point", "coordinates": [rng.randrange(-3, 3), rng.randrange(-3, 3)]}) if rng.random() < 0.4 else None
        x = rng.randrange(4)
        box = {"id": f"p{x}", "bounding_box": {"type": "Polygon", "coordinates": [[[x, x], [x + 2, x], [x + 2, x + 1], [x, x + 1]]]}}
        place = json.dumps(box) if rng.random() < 0.3 else None
        reply = rng.choice([None, 7, rng.randrange(40), 500 + i])  # user 7 is a hub
        rows.append((i, rng.randrange(25), reply, geo, place))
    rows += [rows[3], rows[9], (900, None, 3, None, None), (901, 7, None, "{}", "not json")]
    return rows


def authored(spark, rows, schema):
    return spark.createDataFrame([r for r in rows if r[1] is not None], schema)


def test_live_user_state_equals_the_batch_after_restarts(spark, tmp_path):
    schema = "id long, user_id long, in_reply_to long, geo string, place string"
    rows, src, table, ck = tweet_rows(), f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/ck"
    for at in range(0, len(rows), 140):
        spark.createDataFrame(rows[at : at + 140], schema).repartition(2).write.mode("append").parquet(src)
        stream = message_stream(spark, src, spark.read.parquet(src).schema, fmt="parquet", max_files_per_trigger=1)
        us.run_user_state(spark, stream, table, ck, shards=3, state_partitions=2, buckets=4)

        def flat(df):
            loc = [F.round(f"location.{c}", 6) for c in ("lat", "lon", "confidence")]
            return sorted(map(str, df.select("user_id", "n_points", "n_places", "n_to", "n_by", *loc).collect()))

        assert flat(us.current_user_state(spark, table)) == flat(gr.user_state(authored(spark, rows[: at + 140], schema)))
    # Nothing new: the table stays as it is.
    version = mt.manifest(spark, table)["version"]
    us.run_user_state(spark, stream, table, ck, shards=3, state_partitions=2, buckets=4)
    assert mt.manifest(spark, table)["version"] == version


def test_live_user_state_of_an_empty_stream(spark, tmp_path):
    assert us.current_user_state(spark, f"{tmp_path}/none").collect() == []


def test_cells_take_rows_and_count_seen_in_their_totals():
    from pyspark.sql import Row

    class Items(dict):
        def getValue(self, k):  # noqa: N802
            return self.get(k)

        def updateValue(self, k, v):  # noqa: N802
            self[k] = v

    class Total:
        row = None

        def get(self):
            return self.row

        def update(self, row):
            self.row = row

    def cell():
        p = us.cell_processor()
        p.items, p.total = Items(), Total()
        return p

    def feed(p, kind, *items):
        rows = iter([Row(item=i, lat=la, lon=lo) for i, la, lo in items])
        return [tuple(r)[:5] for r in p.handleInputRows(("u", kind, 0), rows, None)]

    p = cell()
    assert feed(p, "seen", ("", None, None), ("", None, None)) == [("u", "seen", 0, 1, 2)]
    assert feed(p, "seen", ("", None, None)) == [("u", "seen", 0, 1, 3)] and not p.items
    p = cell()
    assert feed(p, "geo", ("a", 0.0, 0.0), ("b", 0.0, 90.0), ("a", 0.0, 0.0)) == [("u", "geo", 0, 2, 3)]
    assert feed(p, "geo", ("b", 0.0, 90.0)) == [("u", "geo", 0, 2, 4)]
    assert [round(x, 9) for x in p.total.row[2:]] == [1, 1, 0] and p.items == {("a",): (2,), ("b",): (2,)}


def test_cells_of_native_state_equal_those_with_item_numbers(spark, tmp_path, monkeypatch):
    schema = "id long, user_id long, in_reply_to long, geo string, place string"
    rows, src = tweet_rows(), f"{tmp_path}/in"
    python = []
    monkeypatch.setattr(us, "cell_processor", lambda f=us.cell_processor: python.append(1) or f())

    def cells(name):
        c = mt.read_table(spark, f"{tmp_path}/{name}")
        return sorted(tuple(r) for r in c.select("user_id", "kind", "shard", "n", "occurrences", *[F.round(v, 9) + 0.0 for v in ("cx", "cy", "cz")]).collect())

    for at in (0, 200):
        spark.createDataFrame(rows[at : at + 200], schema).repartition(2).write.mode("append").parquet(src)
        stream = message_stream(spark, src, spark.read.parquet(src).schema, fmt="parquet", max_files_per_trigger=1)
        for name, numbers in (("native", False), ("maps", True)):
            us.run_user_state(spark, stream, f"{tmp_path}/{name}", f"{tmp_path}/ck-{name}", 3, state_partitions=2, buckets=4, item_numbers=numbers)
            assert len(python) == (at // 200 + numbers)  # rows of the default way never reach Python
        assert cells("native") == cells("maps")
    replies = [r[1] for r in rows[:400] if r[2] == 7 and r[1] is not None]
    hub = [c for c in cells("native") if c[:2] == ("7", "by")]
    assert (sum(c[3] for c in hub), sum(c[4] for c in hub)) == (len(set(replies)), len(replies))
