"""The corpus pipeline: documents -> packed training sequences, in stages that each apply one operator of footfall.llm.

Every stage takes all rows that the one before it kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import mixing, ngram_join, packing, quality_classifier, suffix_dedup
from footfall.llm.queries import tokenizer_path
from footfall.llm.shared import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), F.col("quality").alias("label"))
    return quality_classifier.accepted(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that stand elsewhere too; n_chars follows the text."""
    kept = suffix_dedup.deduplicated(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of their sources; one drawn again is there again."""
    return mixing.mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their token ids."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("ngram_join", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

#: Models, draws and tokens are not SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
