"""Time functions: hour bucket, calendar span labels, lenient parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000

# Span levels and label formats of the time-series output.
LEVELS = ("alltime", "year", "month", "day", "hour")
LABEL_FORMATS = {
    "year": "'year-'yyyy",
    "month": "'month-'yyyy-MM",
    "day": "'day-'yyyy-MM-dd",
    "hour": "'hour-'yyyy-MM-ddHH':00'",
}
# Levels the trend job publishes.
JOB_LEVELS = ("alltime", "year", "month")

# Accepted text layouts of a Created value, tried in order.
# The stream's layout "EEE MMM dd HH:mm:ss Z yyyy" is parsed after the weekday
# is cut off (Spark rejects EEE when parsing).
CREATED_FORMATS = (
    "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSSSSS][XXX]",
    "yyyy-MM-dd HH:mm[:ss][.SSSSSSSSS][XXX]",
    "yyyy-MM-dd",
    "MMM dd HH:mm:ss Z yyyy",
    "d MMM yyyy HH:mm[:ss][ Z]",
    "M/d/yyyy h:mm[:ss] a",
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_floor(ts) -> Column:
    """Wall-clock hour of a timestamp (F3 without the epoch step)."""
    return F.date_trunc("HOUR", _c(ts))


def wall_clock_ms(ts) -> Column:
    """Epoch milliseconds of the wall-clock fields, ignoring any zone.

    Works for TIMESTAMP (read in the session zone) and TIMESTAMP_NTZ alike.
    """
    t = _c(ts)
    return (
        F.unix_date(F.to_date(t)).cast("long") * F.lit(MS_PER_DAY)
        + F.hour(t).cast("long") * F.lit(MS_PER_HOUR)
        + F.minute(t).cast("long") * F.lit(60_000)
        + (F.second(t).cast("long") * F.lit(1000))
    )


def hour_ms(ts) -> Column:
    """floor to the hour, epoch milliseconds of the wall-clock hour."""
    t = _c(ts)
    return F.unix_date(F.to_date(t)).cast("long") * F.lit(MS_PER_DAY) + F.hour(t).cast("long") * F.lit(MS_PER_HOUR)


def timespan_label(level: str, ts) -> Column:
    """``alltime``, ``year-Y``, ``month-Y-MM``, ``day-Y-MM-DD``, ``hour-Y-MM-DDHH:00``."""
    if level == "alltime":
        return F.lit("alltime")
    return F.date_format(_c(ts), LABEL_FORMATS[level])


def timespan_labels(ts, levels=JOB_LEVELS) -> Column:
    """Array of the span labels a timestamp belongs to."""
    return F.array(*[timespan_label(lv, ts) for lv in levels])


def span_level(timespan) -> Column:
    """Level of a span label: text before the first '-' (``alltime`` has none)."""
    return F.substring_index(_c(timespan), "-", 1)


def matches_timespan(ts, timespan: str) -> Column:
    """The timestamp's label at the span's level equals the span."""
    if timespan == "alltime":
        return F.lit(True)
    level = timespan.split("-", 1)[0]
    return timespan_label(level, ts) == F.lit(timespan)


def parse_created(text, tz: str = "wall") -> Column:
    """lenient parse of a Created text; null when nothing matches.

    ``tz="wall"`` keeps the wall-clock fields and ignores a zone offset (the
    reference's bucketing); ``tz="utc"`` converts offsets to UTC.
    """
    t = F.trim(_c(text))
    # drop a leading weekday ("Wed Aug 27 13:08:45 +0000 2008")
    t = F.regexp_replace(t, r"^[A-Za-z]{3} (?=[A-Za-z]{3} )", "")
    # and that of a mail date ("Fri, 04 Mar 2016 05:06:07 GMT"), whose zone name is an offset of zero
    t = F.regexp_replace(F.regexp_replace(t, r"^[A-Za-z]{3}, ", ""), r" (GMT|UTC|UT|Z)$", " +0000")
    if tz == "wall":
        # cut the offset so the wall-clock fields are kept
        t_wall = F.regexp_replace(t, r"( [A-Z]{3,4}|Z| ?[+-]\d\d:?\d\d)$", "")
        t_wall = F.regexp_replace(t_wall, r" [+-]\d{4} (\d{4})$", " +0000 $1")
        parsed = [F.try_to_timestamp(t_wall, F.lit(f)) for f in CREATED_FORMATS]
    else:
        parsed = [F.try_to_timestamp(t, F.lit(f)) for f in CREATED_FORMATS]
    return F.coalesce(*parsed)


def epoch_day(ms) -> Column:
    """whole days since the epoch of an epoch-millisecond value."""
    return F.floor(_c(ms) / F.lit(MS_PER_DAY)).cast("long")
