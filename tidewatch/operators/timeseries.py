"""Hourly trend series per calendar span.

Plan shape (one scan of the messages, no driver loop):

1. ``hour_cube``: explode the four lists to (hour, section, value) and count
   occurrences (repeats inside a record count) and records (a record counts
   once) with a partial/final hash aggregate.
2. ``span_counts``: roll the cube up to alltime / year / month. Both measures
   are additive over hours because a record sits in exactly one hour.
3. ``topk_per_timespan``: ``row_number() <= k`` per span; Spark plans a
   WindowGroupLimit before the exchange so only k rows per span and map task
   are shuffled, even for the single ``alltime`` span.
4. ``hourly_counts``: the span's hours × its top entries (≤ k per span, a
   bounded table) left-joined to the cube's record counts, zero-filled.
5. ``timeseries_documents``: one document per span, hours ascending.

The cube feeds steps 2-4; Spark reuses its exchange, so the input is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.labels import SECTIONS, section_label
from tidewatch.functions.timeutil import JOB_LEVELS, hour_floor, hour_ms, matches_timespan, timespan_label

DEFAULT_K = 5


def _list(c: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast("array<string>"))


def has_sections(df: DataFrame) -> Column:
    """Total length of the four lists > 0; a missing list counts 0."""
    total = sum((F.size(_list(c)) for c in SECTIONS), F.lit(0))
    return total > 0


def has_created(df: DataFrame) -> Column:
    """Created present (and parsed)."""
    return F.col("Created").isNotNull()


def qualifying(messages: DataFrame) -> DataFrame:
    """Records the trend job counts: P1 and P2."""
    return messages.filter(has_created(messages) & has_sections(messages))


def section_entries(messages: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """A1 input: one row per list element (section, value, first).

    ``first`` marks the first occurrence of a value inside its record's list,
    so ``count(*)`` gives occurrences and ``count_if(first)`` gives records
    without needing a record id.
    """
    def tag(c: str):
        return lambda v, i: F.struct(
            F.lit(c).alias("section"),
            v.alias("value"),
            (F.array_position(_list(c), v) == i + 1).alias("first"),
        )

    parts = [F.transform(_list(c), tag(c)) for c in SECTIONS]
    return (
        qualifying(messages)
        .select(hour_floor("Created").alias("hour"), *extra, F.inline(F.concat(*parts)))
        .filter(F.col("value").isNotNull())
    )


def hour_cube(messages: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(hour, section, value) → occurrences, records; the one aggregation over raw input."""
    return section_entries(messages, extra).groupBy("hour", *extra, "section", "value").agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.count_if("first").alias("records"),
    )


def with_spans(df: DataFrame, hour_col: str = "hour", levels=JOB_LEVELS) -> DataFrame:
    """Explode each row to the span labels its hour belongs to (A2)."""
    return df.withColumn(
        "timespan", F.explode(F.array(*[timespan_label(lv, F.col(hour_col)) for lv in levels]))
    )


def span_cube(cube: DataFrame, levels=JOB_LEVELS, extra: tuple[str, ...] = ()) -> DataFrame:
    """(timespan, hour, section, value, occurrences, records): the cube per span (map-side only)."""
    return with_spans(cube, levels=levels).select(
        "timespan", *extra, "hour", "section", "value", "occurrences", "records")


def span_counts(spans: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """A1 per span: (timespan, section, value, occurrences, records)."""
    return spans.groupBy("timespan", *extra, "section", "value").agg(
        F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records")
    )


def distinct_timespans(spans: DataFrame) -> DataFrame:
    """A2: the span labels present in the data."""
    return spans.select("timespan").distinct()


def topk_per_timespan(counts: DataFrame, k: int = DEFAULT_K, extra: tuple[str, ...] = ()) -> DataFrame:
    """The k most frequent (section, value) per span by occurrences.

    Ties break on section, then value (deterministic; Q2).
    """
    w = Window.partitionBy("timespan", *extra).orderBy(F.desc("occurrences"), "section", "value")
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("timespan", *extra, "rank", "section", "value", "occurrences", "records")
    )


def hourly_counts(spans: DataFrame, topk: DataFrame, k: int = DEFAULT_K, extra: tuple[str, ...] = ()) -> DataFrame:
    """A3 + J7: per (span, hour) the records (``n``) and occurrences that contain
    each top entry, zero-filled over the hours that hold any qualifying record.

    ``topk`` has at most k rows per span and the number of spans is bounded by
    the calendar (1 + years + 12·years), so it is broadcast; with ``extra`` keys
    (tiles) it has no such bound and the join is left to the planner. Each cube row is
    tagged with the rank of its entry (or null) and the rows are pivoted per
    (span, hour) with k conditional sums, which gives the zero rows for free;
    the pivot is unrolled back to one row per existing rank.
    """
    top = topk.select("timespan", *extra, "rank", "section", "value")
    top = top if extra else F.broadcast(top)
    tagged = spans.join(top, ["timespan", *extra, "section", "value"], "left")
    sums = []
    for r in range(1, k + 1):
        hit = F.col("rank") == r
        sums.append(F.sum(F.when(hit, F.col("records")).otherwise(0)).alias(f"n{r}"))
        sums.append(F.sum(F.when(hit, F.col("occurrences")).otherwise(0)).alias(f"o{r}"))
    pivot = tagged.groupBy("timespan", *extra, "hour").agg(*sums)
    cells = F.array(*[
        F.struct(F.lit(r).alias("rank"), F.col(f"n{r}").alias("n"), F.col(f"o{r}").alias("occurrences"))
        for r in range(1, k + 1)
    ])
    return (
        pivot.select("timespan", *extra, "hour", F.inline(cells))
        .join(top, ["timespan", *extra, "rank"])
        .select(
            "timespan",
            *extra,
            "hour",
            hour_ms("hour").alias("hour_ms"),
            "rank",
            "section",
            "value",
            F.col("n").cast("long").alias("n"),
            F.col("occurrences").cast("long").alias("occurrences"),
        )
    )


def trend_tables(messages: DataFrame, k: int = DEFAULT_K, levels=JOB_LEVELS,
                 extra: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """All intermediate tables of the trend job, sharing one cube.

    ``extra`` adds grouping keys to every step (X1: a location tile); the
    broadcast top-k then holds k rows per (span, key), still bounded by the
    calendar times the key domain (e.g. the tile grid).
    """
    cube = hour_cube(messages, extra)
    spans = span_cube(cube, levels, extra)
    counts = span_counts(spans, extra)
    top = topk_per_timespan(counts, k, extra)
    hourly = hourly_counts(spans, top, k, extra)
    return {"cube": cube, "spans": spans, "counts": counts, "topk": top, "hourly": hourly}


def timeseries_long(messages: DataFrame, k: int = DEFAULT_K, levels=JOB_LEVELS,
                    extra: tuple[str, ...] = ()) -> DataFrame:
    """Long form of the trend output: (timespan, hour_ms, rank, label, n, occurrences)."""
    hourly = trend_tables(messages, k, levels, extra)["hourly"]
    return hourly.select(
        "timespan", *extra, "hour_ms", "rank", section_label("section", "value").alias("label"), "n", "occurrences"
    )


def timeseries_documents(long: DataFrame) -> DataFrame:
    """A4 + W2: one document per span.

    ``labels`` = ["x", label_1..label_n] in rank order; ``graphData`` = rows
    [hour_ms, c_1..c_n] in ascending hour. Two aggregations in sequence: per
    (span, hour) the ≤ k cells in rank order, then per span the hours in
    order. Every hour of a span carries the same ranks (the zero-filled
    pivot), so the labels are read from the cells of the first hour.
    """
    per_hour = long.groupBy("timespan", "hour_ms").agg(
        F.array_sort(F.collect_list(F.struct("rank", "n", "label"))).alias("cells")
    )
    per_span = per_hour.groupBy("timespan").agg(
        F.array_sort(F.collect_list(F.struct("hour_ms", "cells"))).alias("r")
    )
    return per_span.select(
        "timespan",
        F.concat(F.array(F.lit("x")), F.transform(F.col("r")[0]["cells"], lambda c: c["label"])).alias("labels"),
        F.transform("r", lambda e: F.concat(F.array(e["hour_ms"]), F.transform(e["cells"], lambda c: c["n"])))
        .alias("graphData"),
    )


def document_json(docs: DataFrame) -> DataFrame:
    """S16 payload: (timespan, file name, JSON text)."""
    return docs.select(
        "timespan",
        F.concat(F.translate("timespan", "/", "_"), F.lit(".json")).alias("name"),
        F.to_json(F.struct("labels", "graphData")).alias("json"),
    )


def filter_timespan(messages: DataFrame, timespan: str) -> DataFrame:
    """P15 as an API: records whose label at the span's level equals the span."""
    return messages.filter(matches_timespan("Created", timespan))
