"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns documents; between stages they are written as Parquet
and read again, so a lost executor costs the stage at hand and not those before.  Null texts pass the
filters and stay null; the operators' docstrings say what they do with other odd rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillmark.llm import decontaminate, linededup, mixing, simhash, toxicity
from rillmark.llm.base import stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a repeated window covers go; the documents stay."""
    return linededup.dedup(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go; the documents stay."""
    cleaned = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), docs.columns, clean=True)
    return cleaned.select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What training takes of each document, and when, in training order."""
    return mixing.in_training_order(mixing.mix(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# the classifier and the fingerprints are no SQL; tests compare the stages with plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
