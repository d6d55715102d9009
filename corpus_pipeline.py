"""From documents to packed training sequences: quality rules, exact and near dedup, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from changeflow.llm.common import stage, table
from changeflow.llm.exact_dedup import exact_dedup
from changeflow.llm.jaccard_join import near_dedup
from changeflow.llm.packing import pack
from changeflow.llm.pii import remove_personal_data
from changeflow.llm.quality import quality_filter

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality_filter(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return exact_dedup(docs).filter("kept").select("doc.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays."""
    return near_dedup(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that give it away are replaced; ``n_chars`` follows."""
    clean = remove_personal_data(docs)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))) if "n_chars" in clean.columns else clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Packing has no SQL; tests hold run() against a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        rows = stage(step(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
