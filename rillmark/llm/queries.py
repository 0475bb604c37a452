"""The registered queries of this package over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillmark.llm import centroids, contentsort, decontaminate, fim, language, linededup, lm, mixing, quality, secrets, simhash, topk, toxicity
from rillmark.llm.base import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.in_training_order(mixing.mix(table(spark, sf_dir, "documents")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.report(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contentsort.report(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(table(spark, sf_dir, "documents"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_quality,
        op2_mixing,
        op3_language,
        op4_topk,
        op5_toxicity,
        op6_language_model,
        op7_line_dedup,
        op8_decontamination,
        op9_secret_scan,
        op10_simhash,
        op11_exact_dedup,
        op12_centroids,
        op13_fill_in_middle,
    )
}
