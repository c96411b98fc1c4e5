"""Versioned merge table (S11, F13): insert-or-merge as an atomic write.

Layout. Rows are dealt to ``buckets`` by a hash of their keys. A merge writes
the buckets that it touches to a folder of its own, ``data/v=N/bucket=B``, and
then one manifest, ``manifests/N.json``, that names the version of every
bucket. The manifest appears by a rename, so readers see the old state or the
new one; what a crash leaves behind without a manifest is never read, and the
next merge overwrites it. One writer at a time (a second one fails on the
rename); readers of the ``KEEP`` last versions are not disturbed.

A merge reads the touched buckets only. A batch of changes that is measured to
be small is broadcast, so that the stored rows are scanned and written again
without a shuffle; a larger one is joined by shuffle.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.common import BROADCAST_MAX_BYTES, measured_bytes

BUCKETS = 64
KEEP = 2


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class _Files:
    """The few file system calls that the manifests need, on any file system Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(x.getPath().getName() for x in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        source = self.fs.open(self.path(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def publish(self, name: str, text: str) -> None:
        """Write a file that appears whole, and fail if it is there."""
        hidden = self.path(f"{name}.part")
        out = self.fs.create(hidden, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(hidden, self.path(name)):
            raise RuntimeError(f"another writer published {name}")

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _versions(files: _Files) -> list[int]:
    return [int(n.removesuffix(".json")) for n in files.names("manifests") if n.endswith(".json")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The manifest of a version (the last one by default), or None without any."""
    files = _Files(spark, path)
    found = _versions(files)
    if not found:
        return None
    return json.loads(files.read(f"manifests/{version if version is not None else found[-1]:012d}.json"))


def _rows(spark: SparkSession, path: str, m: dict, buckets: list[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(m["schema"])
    wanted = [int(b) for b in m["at"]] if buckets is None else [b for b in buckets if str(b) in m["at"]]
    folders = [f"{path.rstrip('/')}/data/v={m['at'][str(b)]}/bucket={b}" for b in wanted]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The rows of a version (the last one by default), or None where nothing was written yet."""
    m = manifest(spark, path, version)
    return None if m is None else _rows(spark, path, m)


def merge_rows(old: DataFrame, new: DataFrame, keys: list[str], fill: bool, small: bool, add: tuple[str, ...] = ()) -> DataFrame:
    """Rows of both, one per key: values of ``new`` win, with ``fill`` its nulls keep the old values;
    columns of ``add`` are summed."""
    values = [c for c in old.columns if c not in keys]
    renamed = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_hit"))
    total = {c: F.coalesce(F.col(f"_new_{c}"), F.lit(0)) + F.coalesce(F.col(c), F.lit(0)) for c in add}
    pick = [
        total[c].alias(c) if c in add else (F.coalesce(F.col(f"_new_{c}"), F.col(c)) if fill else F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c))).alias(c)
        for c in values
    ]
    if not small:
        return old.join(renamed, keys, "full").select(*keys, *pick)
    changed = old.join(F.broadcast(renamed), keys, "left").select(*keys, *pick)
    present = old.select(*keys).join(F.broadcast(new.select(*keys)), keys, "left_semi")  # at most as many as ``new``
    return changed.unionByName(new.join(F.broadcast(present), keys, "left_anti").select(*keys, *values))


def merge(spark: SparkSession, path: str, new: DataFrame, keys: list[str], fill: bool = True, token: int | None = None,
          buckets: int = BUCKETS, broadcast_bytes: int = BROADCAST_MAX_BYTES, add: tuple[str, ...] = ()) -> int:
    """Insert or merge ``new`` (one row per key; rows with a null key are left out) and return the
    version. The first merge fixes keys, columns and number of buckets. ``token`` (a batch number)
    makes a repeated merge a no-op: a token not above the last one is taken as applied. Columns of
    ``add`` are counts: the new ones are added to the old."""
    files, m = _Files(spark, path), manifest(spark, path)
    if m is not None:
        if token is not None and m["token"] is not None and token <= m["token"]:
            return m["version"]
        keys, buckets = m["keys"], m["buckets"]
        schema = T.StructType.fromJson(m["schema"])
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in new.columns]
        new = new.select("*", *missing).select(*[F.col(f.name).cast(f.dataType) for f in schema])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    new = new.filter(known).withColumn("bucket", bucket_of(keys, buckets)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # at most ``buckets`` numbers
        rows = new.drop("bucket")
        version = 0 if m is None else m["version"] + 1
        if m is not None:
            old = _rows(spark, path, m, touched)
            rows = merge_rows(old, rows, keys, fill, measured_bytes(rows) <= broadcast_bytes, add)
        rows.withColumn("bucket", bucket_of(keys, buckets)).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/v={version}")
        at = dict(m["at"] if m else {}) | {str(b): version for b in touched}
        plain = new.drop("bucket").schema
        files.publish(f"manifests/{version:012d}.json", json.dumps({
            "version": version, "token": token, "keys": keys, "buckets": buckets, "schema": plain.jsonValue(), "at": at}))
    finally:
        new.unpersist()
    remove_old(spark, path)
    return version


def remove_old(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Delete manifests before the last ``keep`` and the bucket folders that no manifest left names."""
    files = _Files(spark, path)
    found = _versions(files)
    for v in found[:-keep]:
        files.drop(f"manifests/{v:012d}.json")
    used: dict[int, set[int]] = {}
    for v in found[-keep:]:
        for b, at in manifest(spark, path, v)["at"].items():
            used.setdefault(at, set()).add(int(b))
    for folder in files.names("data"):
        v = int(folder.removeprefix("v="))
        if v > found[-1]:
            continue
        if v not in used:
            files.drop(f"data/{folder}")
            continue
        for name in files.names(f"data/{folder}"):
            if name.startswith("bucket=") and int(name.removeprefix("bucket=")) not in used[v]:
                files.drop(f"data/{folder}/{name}")
