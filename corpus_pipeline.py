"""From raw documents to packed training sequences, stage by stage.

Each stage works on all that the one before it kept, is written as Parquet, and is read again by the
next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import line_dedup, near_dedup, packing, quality_classifier, substring_dedup
from quern.llm.common import recorded, release, settings, written

CAPACITY = 2048
#: Words whose tokens a worker of the last stage keeps: by then its executor's heap has grown to its full size.
CACHE_WORDS = 400_000
#: While a stage runs: rows of an Arrow batch, as whole texts fill a worker's memory, and a query's
#: shuffle files go with its end, not with the driver's next garbage collection.
SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Stores a stage's result, then deletes the tables under it. The result is its caller's, who may ``release`` it."""

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with settings(spark, SETTINGS), recorded() as tables:
            found = work(spark, docs, sf_dir)
            out = written(found, "stage")
        release(*(t for t in tables if t is not out))
        return out

    return run_stage


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects. Rows without an id are judged by none and stay."""
    verdicts = quality_classifier.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # rows of equal id may hold different texts: one rejected row of an id rejects only if all are
    rejected = verdicts.groupBy("doc_id").agg(F.max("kept").alias("any_kept")).where(~F.col("any_kept")).select("doc_id")
    return docs.join(rejected, "doc_id", "left_anti").select(*_columns(docs))


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that repeat, exactly or nearly, all but their first occurrence."""
    return _counted(line_dedup.remove_duplicate_lines(docs))


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: five-word shingles, similarity 0.8."""
    dropped = near_dedup.near_duplicates(docs, size=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*_columns(docs))


@_stage
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more that a document of smaller id also holds."""
    return _counted(substring_dedup.remove_repeats(docs, size=50))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of CAPACITY tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY, cache_words=CACHE_WORDS)


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near dedup", near),
    ("substring dedup", substrings),
    ("packing", pack),
]

#: SQL can't express the classifier's or the tokenizer's work.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if before is not None:
            release(before)
        before = docs
    return docs
