import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions.timeutil import parse_created, timespan_label
from tidewatch.operators import timeseries as ts

SCHEMA = ("MessageId string, Created timestamp, Keywords array<string>, Sectors array<string>, "
          "Groups array<string>, Statuses array<string>")


def msgs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def t(h, d=1, m=1):
    return dt.datetime(2024, m, d, h, 15)


def test_repeat_counts_occurrences_not_records(spark):
    df = msgs(spark, [("1", t(1), ["a", "a", "b"], [], [], [])])
    c = ts.hour_cube(df).filter("value = 'a'").first()
    assert (c.occurrences, c.records) == (2, 1)


def test_tie_break_at_rank_k(spark):
    # six keywords, each once: ranks fall back to section then value
    df = msgs(spark, [("1", t(1), ["f", "e", "d", "c", "b", "a"], [], [], [])])
    top = ts.trend_tables(df)["topk"].filter("timespan = 'alltime'").orderBy("rank")
    assert [r.value for r in top.collect()] == ["a", "b", "c", "d", "e"]


def test_zero_fill_hour_without_top_entry(spark):
    rows = [(str(i), t(1), ["x"], [], [], []) for i in range(3)] + [("9", t(2), ["y"], [], [], [])]
    long = ts.timeseries_long(msgs(spark, rows), k=1).filter("timespan = 'alltime'")
    got = {(r.hour_ms, r.label): r.n for r in long.collect()}
    h1 = int(dt.datetime(2024, 1, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    h2 = h1 + 3_600_000
    assert got == {(h1, "kw-x"): 3, (h2, "kw-x"): 0}


def test_missing_lists_and_created(spark):
    df = msgs(spark, [("1", None, ["a"], None, None, None), ("2", t(3), None, None, None, None),
                      ("3", t(3), None, None, ["g"], None)])
    c = ts.hour_cube(df).collect()
    assert [(r.section, r.value) for r in c] == [("Groups", "g")]


def test_rollup_equals_direct_count(spark):
    rows = [(str(i), t(i % 24, d=1 + i % 3, m=1 + i % 2), ["a", "b"][: 1 + i % 2], ["s"], [], ["st"])
            for i in range(60)]
    df = msgs(spark, rows)
    rolled = ts.trend_tables(df)["counts"]
    direct = (ts.section_entries(df)
              .withColumn("timespan", F.explode(F.array(F.lit("alltime"), timespan_label("year", "hour"),
                                                        timespan_label("month", "hour"))))
              .groupBy("timespan", "section", "value").agg(F.count(F.lit(1)).alias("occurrences"),
                                                           F.count_if("first").alias("records")))
    assert sorted(rolled.collect()) == sorted(direct.collect())


def test_documents_shape(spark):
    rows = [("1", t(1), ["a"], [], [], []), ("2", t(5), ["a", "b"], [], [], [])]
    docs = ts.timeseries_documents(ts.timeseries_long(msgs(spark, rows)))
    d = docs.filter("timespan = 'alltime'").first()
    assert d.labels[0] == "x" and d.labels[1:] == ["kw-a", "kw-b"]
    hours = [r[0] for r in d.graphData]
    assert hours == sorted(hours) and d.graphData[1][1:] == [1, 1]


def test_created_offset_wall_vs_utc(spark):
    df = spark.createDataFrame([("2024-02-01T02:30:00+07:00",), ("Thu Feb 01 02:30:00 +0700 2024",),
                                ("garbage",)], "c string")
    out = df.select(timespan_label("month", parse_created("c", "wall")).alias("w"),
                    timespan_label("month", parse_created("c", "utc")).alias("u")).collect()
    assert out[0].w == "month-2024-02" and out[0].u == "month-2024-01"
    assert out[1].w == "month-2024-02"
    assert out[2].w is None


def test_labels_all_levels(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 3, 4, 5, 6),)], "c timestamp")
    r = df.select(*[timespan_label(lv, "c").alias(lv) for lv in ("alltime", "year", "month", "day", "hour")]).first()
    assert tuple(r) == ("alltime", "year-2016", "month-2016-03", "day-2016-03-04", "hour-2016-03-0405:00")
