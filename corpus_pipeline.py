"""From raw documents to packed training sequences: quality, near duplicates, secrets, mix, packing.

Each stage is written as Parquet and read again before the next. All but the last keep
the columns of the documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareweather.llm import common, jaccard_join, mixing, packing, quality_fm, secret_scan

#: Characters of a block of texts for the tokenizer, about: an executor holds what the stages before have left as well.
BLOCK_CHARS = 2_500_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones, by labels of documents that came in."""
    machine = quality_fm.train(docs, common.table(spark, sf_dir, "labels"))
    return quality_fm.keep_good(docs, machine)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its shingles of five words."""
    with common.small_batches(spark):
        return jaccard_join.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets in its text masked."""
    return secret_scan.masked(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with the sequences that hold them."""
    with common.small_batches(spark):
        return packing.packed(docs, block_chars=BLOCK_CHARS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("sequences", sequences),
]

#: The classifier, the tokenizer and best fit can't be put in SQL; the stages are tested one by one.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Between them, rows are in the folder of spark.checkpoint.dir."""
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
