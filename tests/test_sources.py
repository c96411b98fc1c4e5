from pyspark.sql import functions as F

from tidewatch.operators import timeseries as ts
from tidewatch.sources import messages as ms
from tidewatch.sources import tweets as tw


def test_message_lines_dead_letters(spark):
    lines = [
        '{"MessageId":"1","Created":"2024-01-05T10:20:00","Keywords":["a"]}',
        '{"MessageId":"2","Created":"Fri Jan 05 10:20:00 +0000 2024","Keywords":null,"Groups":["g"]}',
        '{"MessageId":"3","Keywords":["a"]}',                      # missing Created
        '{"MessageId":"4","Created":"05/01/2024","Keywords":["a"]}',  # unparsable Created
        'not json at all',
        '',
        '{"MessageId":"5","Created":"2024-01-05T11:00:00"}',       # every list missing
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = ms.parse_message_lines(df)
    status = {r._line: r._status for r in parsed.select("_line", "_status").collect()}
    assert [status[x] for x in lines] == ["ok", "ok", "missing_created", "bad_created", "malformed", "empty", "ok"]
    good, bad = ms.split_bad_records(parsed)
    assert good.count() == 3 and bad.count() == 4
    # null and missing lists are tolerated by the trend job (record 5 has no sections)
    cube = ts.hour_cube(good).collect()
    assert sorted((r.section, r.value, r.records) for r in cube) == [("Groups", "g", 1), ("Keywords", "a", 1)]


def test_prune_newlines_glues_words(spark):
    from tidewatch.functions.text import prune_newlines

    df = spark.createDataFrame([('{"text":"one\\ntwo\\rthree"}',)], "raw string")
    r = df.select(F.from_json(prune_newlines("raw"), "text string")["text"].alias("t")).first().t
    assert r == "onetwothree"


def test_insert_only_keeps_first_row(spark):
    schema = "epoch_day long, id long, text string, arrival long"
    first = spark.createDataFrame([(1, 10, "a", 1), (1, 10, "dup-same-day", 2), (2, 10, "other day", 3)], schema)
    kept = tw.insert_new(first, None, order_col="arrival")
    assert sorted((r.epoch_day, r.id, r.text) for r in kept.collect()) == [(1, 10, "a"), (2, 10, "other day")]
    later = spark.createDataFrame([(1, 10, "retry", 4), (3, 11, "new", 5)], schema)
    new = tw.insert_new(later, kept.drop("arrival"), order_col="arrival")
    assert [(r.epoch_day, r.id, r.text) for r in new.collect()] == [(3, 11, "new")]


def test_flatten_roundtrip_drops_dot_columns(spark):
    df = spark.createDataFrame([("u", (1.0, 2.0), [1, 2], "x")], "user_id string, loc struct<a:double,b:double>, l array<int>, `.meta` string")
    flat = ms.flatten_row(df)
    assert flat.columns == ["user_id", "loc", "l"] and dict(flat.dtypes)["loc"] == "string"
    back = ms.unflatten_row(flat, df.drop(".meta").schema).first()
    assert back.loc.a == 1.0 and back.l == [1, 2]


def test_user_bucket_one_digit_id(spark):
    df = spark.createDataFrame([("7",), ("123",)], "u string")
    assert [r.b for r in df.select(F.substring("u", 1, 2).alias("b")).collect()] == ["7", "12"]


def test_created_layouts(spark):
    from tidewatch.functions.timeutil import parse_created

    rows = ["2016-03-04T05:06:07.123456Z", "2016-03-04T05:06", "3/4/2016 5:06:07 PM", "Fri, 04 Mar 2016 05:06:07 GMT",
            "2016-03-04T05:06:07+02:00", "2016-03-04", "Fri Mar 04 05:06:07 +0000 2016", "04/03/2016 05:06", "nonsense"]
    got = [str(r.t) for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, s string").orderBy("i").select(
        parse_created("s").alias("t")).collect()]
    assert got == ["2016-03-04 05:06:07.123456", "2016-03-04 05:06:00", "2016-03-04 17:06:07", "2016-03-04 05:06:07",
                   "2016-03-04 05:06:07", "2016-03-04 00:00:00", "2016-03-04 05:06:07", "None", "None"]


def test_reference_lines_keep_their_order_over_several_splits(spark, tmp_path):
    from tidewatch.sources.refdata import read_refdata_lines

    folder = tmp_path / "keywords" / "en"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("\n".join(f"a{i:05d}" for i in range(3000)))
    (folder / "b.csv").write_text("\n".join(f"b{i:05d}" for i in range(50)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = [r.value for r in read_refdata_lines(spark, str(tmp_path), "keywords").orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(got) and len(got) == 3050


def test_track_list_has_no_cap_of_its_own(spark):
    from tidewatch.sources.refdata import track_list, track_list_dropped

    lines = spark.createDataFrame([(i, f"T{i:03d}, u{i:03d}") for i in range(300)], "seq long, value string")
    every = [r.term for r in track_list(lines).orderBy("pos").collect()]
    assert len(every) == 600 and every[:3] == ["t000", "u000", "t001"]
    kept = [r.term for r in track_list(lines, 400).orderBy("pos").collect()]
    dropped = [r.term for r in track_list_dropped(lines, 400).orderBy("pos").collect()]
    assert len(kept) == 399 and kept + dropped == every


def test_translations_are_last_wins(spark):
    from tidewatch.sources.refdata import build_dictionaries

    sheet = spark.createDataFrame([("en", "Car ", "auto, wagon", "car", 1), ("en", "Truck", "auto", "truck", 2)],
                                  "lang string, term string, synonyms string, english string, seq long")
    d = build_dictionaries(sheet)
    assert {(r.term, r.canonical) for r in d["translations"].collect()} == {
        ("car", "car"), ("auto", "truck"), ("wagon", "car"), ("truck", "truck")}
    assert {r.keyword for r in d["keywords"].collect()} == {"car", "auto", "wagon", "truck"}


def test_messages_from_a_glob_and_json_sink(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"m{k}.json").write_text('{"MessageId":"%d","Created":"2024-01-05T10:20:00","Keywords":["a"]}\nbroken\n' % k)
    parsed = ms.read_messages(spark, str(tmp_path / "*.json"))
    good, bad = ms.split_bad_records(parsed)
    assert sorted(r.MessageId for r in good.collect()) == ["0", "1", "2"] and bad.count() == 3
    rows = spark.createDataFrame([("s1", "a", 1), ("s2", None, 2)], "Source string, t string, n int")
    assert sorted((r.key, r.value) for r in ms.to_json_rows(rows, "Source").collect()) == [
        ("s1", '{"Source":"s1","t":"a","n":1}'), ("s2", '{"Source":"s2","n":2}')]
    ms.write_json_sink(rows, str(tmp_path / "sink"))
    assert sorted((r.Source, r.n) for r in spark.read.json(str(tmp_path / "sink")).collect()) == [("s1", 1), ("s2", 2)]


def test_insert_reads_only_the_days_of_the_batch(spark, tmp_path):
    schema = "epoch_day long, id long, text string"
    path = str(tmp_path / "tweets")
    tw.write_tweets(spark, spark.createDataFrame([(d, d * 10, "a") for d in range(5)], schema), path)
    out = tw.write_tweets(spark, spark.createDataFrame([(3, 30, "again"), (3, 31, "new")], schema), path)
    assert sorted((r.epoch_day, r.id, r.text) for r in out.collect()) == sorted([(d, d * 10, "a") for d in range(5)] + [(3, 31, "new")])
    plan = spark.read.parquet(path).filter(F.col("epoch_day").isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "epoch_day" in plan[plan.index("PartitionFilters"):]
