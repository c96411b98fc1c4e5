"""Session settings used by tests, bench and the driver entry.

Library operators never create a session; they only read settings from the
session of the DataFrame they are given.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in this repo relies on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewatch") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is; without it a cluster session is refused. Only a local session (tests)
    gets a scratch folder of its own.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not conf_dir and not current and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if conf_dir:
        if current is None:
            sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if current:
        return current
    local = tempfile.mkdtemp(prefix="tidewatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint root for written intermediate tables."""
    root = ensure_checkpoint_dir(spark)
    return root.rstrip("/") + "/" + name


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewatch`` importable in the Python workers (pandas UDFs).

    The package is zipped once per application and added with ``addPyFile``,
    the programmatic form of ``--py-files``; Spark distributes it to every
    executor. A no-op when already shipped for this application.
    """
    import shutil

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = tempfile.mkdtemp(prefix="tidewatch-pkg-")
    archive = shutil.make_archive(
        os.path.join(base, "tidewatch"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="tidewatch"
    )
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
