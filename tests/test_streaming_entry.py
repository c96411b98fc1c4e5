import datetime as dt
import json
import os

from pyspark.sql import types as T

from tidewatch.plans.fixtures import new_scratch
from tidewatch.streaming import pipelines as sp

from conftest import SF


def test_late_row_and_duplicate_dropped(spark, tmp_path):
    src = str(tmp_path / "late-src")
    os.makedirs(src, exist_ok=True)
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    b1 = [{"MessageId": "1", "Created": (base + dt.timedelta(seconds=100)).isoformat()}]
    b2 = [{"MessageId": "1", "Created": (base + dt.timedelta(seconds=101)).isoformat()},   # duplicate
          {"MessageId": "3", "Created": (base + dt.timedelta(seconds=95)).isoformat()}]    # within 10 s
    b3 = [{"MessageId": "2", "Created": (base + dt.timedelta(seconds=50)).isoformat()}]    # 50 s late
    for i, b in enumerate((b1, b2, b3)):
        with open(f"{src}/part-{i}.json", "w") as f:
            f.write("\n".join(json.dumps(x) for x in b))
        os.utime(f"{src}/part-{i}.json", (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))  # arrival order
    schema = T.StructType([T.StructField("MessageId", T.StringType()), T.StructField("Created", T.TimestampType())])
    s = sp.message_stream(spark, src, schema, max_files_per_trigger=1)
    out, ck = new_scratch(spark, "late-out"), new_scratch(spark, "late-ck")
    sp.run_available_now(sp.late_events(s), out, ck)
    assert sorted(r.MessageId for r in spark.read.parquet(out).collect()) == ["1", "3"]


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["timespan", "hour_ms", "rank", "label", "n", "occurrences"]
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


def test_every_query_runs_on_smallest_tables(spark):
    """Whole results, under the oracle's column names and with as many rows.

    Queries of the llm subpackage are run in tests/llm.
    """
    import duckdb

    import __spark_entry__ as E
    from tidewatch.plans.catalog import REGISTRY
    from tidewatch.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    queries, oracle = E.queries(), E.oracle_sql()
    for name in REGISTRY:
        df = queries[name](spark, SF)
        n = df.count()
        assert len(df.columns) > 0, name
        if name in oracle:
            found = con.execute(oracle[name])
            assert sorted(c[0] for c in found.description) == sorted(df.columns), name
            assert len(found.fetchall()) == n, name


def test_hourly_stream_equals_batch_cube(spark):
    from tidewatch.functions.timeutil import hour_ms
    from tidewatch.operators import timeseries as ts
    from tidewatch.plans import catalog, fixtures

    stream = {tuple(r) for r in catalog.REGISTRY["hourly_stream"](spark, SF).select(
        "hour_ms", "section", "value", "occurrences", "records").collect()}
    cube = ts.hour_cube(fixtures.msg_events(spark, SF))
    batch = {tuple(r) for r in cube.select(hour_ms("hour").alias("hour_ms"), "section", "value", "occurrences",
                                           "records").collect()}
    assert stream == batch and len(batch) > 0


def test_stream_tagging_equals_batch(spark):
    from tidewatch.plans import catalog

    s = {tuple(r) for r in catalog.REGISTRY["stream_tagging"](spark, SF).collect()}
    b = {tuple(r) for r in catalog.REGISTRY["match_keywords_fuzzy"](spark, SF).collect()}
    assert s == b and len(b) > 0


def test_write_tweets_shuffles_keys_and_keeps_rows_of_repeated_ones(spark, tmp_path):
    from tidewatch.sources import tweets as tw

    schema = "epoch_day long, id long, text string"

    def add(rows):
        got = tw.write_tweets(spark, spark.createDataFrame(rows, schema), f"{tmp_path}/t")
        return sorted(((r.epoch_day, r.id, r.text) for r in got.collect()), key=str)

    first = [(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 5, "d"), (None, 5, "d"), (2, None, "e"), (2, None, "e")]
    once = sorted(set(first), key=str)
    assert add(first) == once
    # stored keys stay; a null key never equals a stored one, as in a plain anti-join
    assert add([(1, 1, "z"), (3, 1, "f"), (3, 1, "f"), (2, None, "g")]) == sorted([*once, (3, 1, "f"), (2, None, "g")], key=str)
    plan = tw.write_tweets(spark, spark.createDataFrame([(9, 9, "x")], schema), f"{tmp_path}/u")
    assert plan.count() == 1


def test_fan_out_takes_packed_files_off_its_queue(spark, tmp_path):
    from tidewatch import schema as S
    from tidewatch.plans import fixtures as fx

    tweets = [json.dumps({"id": i, "timestamp_ms": "86400000", "user": {"id": i % 3}, "text": f"text {i}"}) for i in range(40)]
    notice = json.dumps({"limit": {"track": 3}})
    lines = spark.createDataFrame([(t,) for t in [*tweets, tweets[0], notice]], "value string").repartition(4)
    src = fx.packed_lines(spark, lines, "queue", 5)
    before, parts = fx.file_sizes(spark, src).count(), fx.written_parts(spark, src)
    assert parts == 4 and before > parts
    stream = sp.message_stream(spark, src, S.RAW_TWEET, max_bytes_per_trigger=fx.batch_bytes(spark, src, 2), consume=True)
    sp.fan_out(stream, *(f"{tmp_path}/{x}" for x in ("t", "g", "p", "ck")))
    want = sorted([*((i, f"text {i}") for i in range(40))])
    assert sorted((r.id, r.text) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == want
    for p, cols in (("g", ("id", "text")), ("p", ("cast(message.id as long)", "message.text"))):
        found = spark.read.json(f"{tmp_path}/{p}").selectExpr(*(f"{c} as c{i}" for i, c in enumerate(cols))).collect()
        assert sorted(map(tuple, found)) == sorted([*want, (0, "text 0")])  # queues are at least once
    assert len(os.listdir(f"{tmp_path}/ck/commits")) >= 2 and fx.file_sizes(spark, src).count() < before
