"""Message JSON lines: read, parse, dead-letter, write results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.text import prune_newlines
from tidewatch.functions.timeutil import parse_created
from tidewatch.schema import MESSAGES_RAW

CORRUPT = "_corrupt"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def parse_message_lines(lines: DataFrame, schema: T.StructType = MESSAGES_RAW, tz: str = "wall",
                        value_col: str = "value", prune: bool = False) -> DataFrame:
    """JSON text lines → message columns plus ``_status``.

    ``_status``: ``ok``, ``empty`` (blank line), ``malformed`` (not a JSON
    object), ``missing_created`` or ``bad_created`` (Q5). ``Created`` is
    parsed with ``parse_created``; list columns stay as read (null allowed).
    ``prune`` applies P9 to the raw text first.
    """
    raw = F.col(value_col)
    if prune:
        raw = prune_newlines(raw)
    j = F.from_json(raw, _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = lines.select(raw.alias("_line"), j.alias("_j"))
    cols = [F.col("_j")[f.name].alias(f.name) for f in schema.fields]
    out = parsed.select("_line", F.col(f"_j.{CORRUPT}").alias(CORRUPT), F.col("_j").isNull().alias("_null"), *cols)
    created = parse_created(F.col("Created"), tz) if isinstance(schema["Created"].dataType, T.StringType) else F.col("Created")
    status = (
        F.when(F.col("_line").isNull() | (F.trim("_line") == ""), F.lit("empty"))
        .when(F.col("_null") | F.col(CORRUPT).isNotNull(), F.lit("malformed"))
        .when(F.col("Created").isNull(), F.lit("missing_created"))
        .when(created.isNull(), F.lit("bad_created"))
        .otherwise(F.lit("ok"))
    )
    # status is computed on the raw text before Created is replaced by its parse
    return out.select(
        *[c for c in out.columns if c not in ("_null", CORRUPT, "Created")],
        F.col("Created").alias("CreatedText"), created.alias("Created"), status.alias("_status"),
    )


def read_messages(spark: SparkSession, glob: str, schema: T.StructType = MESSAGES_RAW, tz: str = "wall") -> DataFrame:
    """Newline-delimited JSON from a wildcard path (all files are read in parallel)."""
    return parse_message_lines(spark.read.text(glob), schema, tz)


def split_bad_records(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good messages, dead letters with ``reason`` and the raw line)."""
    good = parsed.filter(F.col("_status") == "ok").drop("_status", "_line", "CreatedText")
    bad = parsed.filter(F.col("_status") != "ok").select(F.col("_status").alias("reason"), F.col("_line").alias("line"))
    return good, bad


def to_json_rows(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """One JSON text per row (``value``), optional partition ``key``."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def write_json_sink(df: DataFrame, path: str, partition_col: str = "Source", mode: str = "append") -> None:
    """JSON files partitioned by source (the hub's partition key)."""
    df.write.mode(mode).partitionBy(partition_col).json(path)


def write_timeseries(docs: DataFrame, path: str, mode: str = "overwrite", only_spans: bool = False) -> None:
    """One JSON document per span; the folder name is the span with
    '/' replaced by '_' (``name=<span>``), the text is the document. With
    ``only_spans`` the folders of other spans stay as they are."""
    out = docs.select(
        F.translate("timespan", "/", "_").alias("name"),
        F.to_json(F.struct("labels", "graphData")).alias("value"),
    )
    writer = out.repartition("name").write.mode(mode).partitionBy("name")
    writer = writer.option("partitionOverwriteMode", "dynamic") if only_spans else writer
    writer.text(path)


def flatten_row(df: DataFrame) -> DataFrame:
    """Object- and list-valued columns become JSON strings; columns whose
    name starts with '.' are dropped."""
    keep = [f for f in df.schema.fields if not f.name.startswith(".")]
    return df.select(*[
        F.to_json(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f"`{f.name}`")
        for f in keep
    ])


def unflatten_row(df: DataFrame, schema: T.StructType) -> DataFrame:
    """P14 inverse: JSON string columns parsed back with the given types."""
    return df.select(*[
        F.from_json(F.col(f.name), f.dataType).alias(f.name)
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f.name).cast(f.dataType)
        for f in schema.fields
    ])
