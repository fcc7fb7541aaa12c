"""Corpus pipeline over ``documents``: quality, near duplicates, PII, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept.  ``run`` writes every stage's result as Parquet in the shared
folder and reads it again for the next one, so a lost executor costs at most
one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ipcforge.llm import dedup, packing, pii, quality
from ipcforge.llm.common import materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return quality.keep_good(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return dedup.keep_first(docs, width=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; ``n_chars`` follows the text."""
    clean = pii.with_pii(docs, spans_col="__spans", redacted_col="text")
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids: one row per piece with its place."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# Tokens, graph components and weak labels are not SQL: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return docs
