"""A corpus pipeline: quality, exact copies, near copies, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next one's ``docs``. All but the last keep the columns of ``documents``. Each
works on everything its predecessor kept; the cases its operator defines (nulls, empty texts, ties,
repeated rows, empty tables, extra columns) hold for the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnflow.llm import exact_dedup, ngram_join, packing, quality, secret_scan
from tarnflow.llm.common import read_table, scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from all labels there are."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return ngram_join.keep_one_per_component(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secret_scan.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and the sequence each lies in."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: SQL cannot express the learned and the iterative stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
