"""The text operators as queries over the driver's tables, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sendstats.llm import oracles
from sendstats.llm.centroids import centroid_clusters
from sendstats.llm.common import ship
from sendstats.llm.decontaminate import leaks
from sendstats.llm.html_blocks import main_texts
from sendstats.llm.importance import importance_sample
from sendstats.llm.language_id import languages
from sendstats.llm.license_scan import license_scan
from sendstats.llm.line_dedup import line_dedup
from sendstats.llm.mixing import mixed_documents
from sendstats.llm.near_dedup import near_duplicates
from sendstats.llm.ngram_join import ngram_join
from sendstats.llm.quality_model import quality_scores
from sendstats.llm.quality_rules import quality_rules
from sendstats.llm.toxicity import toxicity_scores


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixed_documents(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_position")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_read(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"), "text")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_read(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_read(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_read(spark, sf_dir, "documents"))


def op12_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_sample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(_read(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_quality_classifier, op2_source_mixing, op3_language_id, op4_decontamination, op5_html_extraction,
        op6_line_dedup, op7_toxicity, op8_quality_rules, op9_license_scan, op10_near_dedup,
        op11_ngram_join, op12_importance_sample, op13_centroid_clusters,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_source_mixing": oracles.SOURCE_MIXING,
        "op6_line_dedup": oracles.LINE_DEDUP,
        "op8_quality_rules": oracles.QUALITY_RULES,
        "op11_ngram_join": oracles.NGRAM_JOIN,
        "op12_importance_sample": oracles.IMPORTANCE,
        "op13_centroid_clusters": oracles.CENTROIDS,
    }
