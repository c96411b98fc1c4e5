"""Corpus pipeline over ``documents``: five stages, each one operator of ``tidewatch.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.

Defined results: each stage handles null and empty texts, null and repeated
ids, empty tables and extra columns as its operator's module says. A document
that lost all its text to line dedup goes; one that had none before stays.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import line_dedup, lsh_forest, packing, pii, quality
from tidewatch.session import ensure_checkpoint_dir, scratch_dir, ship_package
from tidewatch.sources.tables import table

QUALITY_THRESHOLD = 0.3


def _prepared(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, does not reject."""
    _prepared(spark)
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.good_documents(docs, model, threshold=QUALITY_THRESHOLD)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of lines that stand in an earlier document or place."""
    _prepared(spark)
    out = line_dedup.dedup_lines(docs)
    emptied = (F.col("_lines.removed") > 0) & (F.trim(F.translate("text", "\n\t\r\f\v", "     ")) == "")
    return _counted(out.filter(~F.coalesce(emptied, F.lit(False))).drop("_lines"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates."""
    _prepared(spark)
    judged = lsh_forest.near_duplicates(docs)
    gone = judged.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    _prepared(spark)
    return _counted(pii.redact(docs, pii.train()))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences."""
    _prepared(spark)
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added=added)


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: Classifiers, MinHash and tokenizers are no SQL; tests hold the stages against plain Python versions.
ORACLE_SQL = None


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a stage's table that no later stage reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; the rows of the last one."""
    _prepared(spark)
    root = scratch_dir(spark, f"pipeline-{uuid.uuid4().hex}")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            _drop(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
