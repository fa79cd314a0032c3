"""From raw documents to packed training windows: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and gives a DataFrame; `run` writes each
one's rows to the shared folder as Parquet and hands them to the next.

For every stage: a null text counts as empty, an empty text is a document like
any other (it has a score, equal copies, no words to mix), very long texts are
read whole, rows that repeat doc_id and text are rows of their own until exact
dedup leaves one, a null doc_id stays null, further columns (any names) are
carried along by all stages but the last, and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rosterforge.llm import bag_minhash, chunk_dedup, quality_mil, source_mix, ss_packing
from rosterforge.session import durable

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CACHE_BYTES = 48 << 20  # four stages have filled the executors before words are packed


def in_small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers a thousand rows at a time, a few MB, where Spark's own choice is ten times that."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more; all score alike if fewer than two classes are labelled."""
    in_small_batches(spark)
    return quality_mil.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for A-Z the one with the largest doc_id (null least); ties keep one row."""
    in_small_batches(spark)
    return chunk_dedup.unique(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the one with the smallest doc_id; texts without words are one class."""
    in_small_batches(spark)
    return bag_minhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: whole, in part, or up to three times; texts without words are never taken."""
    in_small_batches(spark)
    return source_mix.apply(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in windows: one row per piece of a document, with its ids."""
    in_small_batches(spark)
    return ss_packing.pack(docs, TOKENIZER, cache_bytes=CACHE_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("source_mix", mixed),
    ("sum_of_squares_packing", packed),
]

# Classifier, signatures and tokenizer are beyond SQL; the tests hold every stage against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
