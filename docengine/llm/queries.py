"""The registered queries of the operators and their SQL, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.llm import bpe, exact_dedup, html, importance, kneser_ney, langid, merkle, mixing, near_dedup, quality_rules, substring_dedup, suffix_dedup, toxicity
from docengine.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(table(spark, sf_dir, "documents"))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).drop("removed")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality_rules": op2_quality_rules,
    "op3_mix_sources": op3_mix_sources,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_html_text": op5_html_text,
    "op6_bpe": op6_bpe,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_language_id": op9_language_id,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_importance": op11_importance,
    "op12_merkle": op12_merkle,
    "op13_suffix_dedup": op13_suffix_dedup,
}
