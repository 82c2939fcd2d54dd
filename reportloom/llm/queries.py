"""Queries of the text operators.  SQL cannot express them; tests hold them against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.llm import bpe, leakage, lookalike, quality


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_prose(_table(spark, sf_dir, "w32_2026"))


def p3_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, posteriors and type of every text."""
    texts = quality.long_texts(_table(spark, sf_dir, "w32_2026"))
    return quality.classify(texts).drop("text")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_ids(_table(spark, sf_dir, "documents"))


def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens by document type."""
    return bpe.token_counts(_table(spark, sf_dir, "documents"), "doc_type")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id")


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaked item with its documents and the largest share found in one."""
    return _leaks(spark, sf_dir).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_documents"), F.round(F.max("share"), 4).alias("largest_share")
    )


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.lookalike_pairs(_table(spark, sf_dir, "documents"))


def p8_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.lookalike_classes(_table(spark, sf_dir, "documents"))


def p8_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling's representative with that of its class; p8_classes has the membership."""
    return lookalike.class_pairs(_table(spark, sf_dir, "documents"))


def p8_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its consistent form."""
    return lookalike.with_skeleton(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "skeleton")


def queries() -> dict:
    return {f.__name__: f for f in (p3_found, p3_types, p6_ids, p6_counts, p7_found, p7_items, p8_found, p8_classes, p8_representatives, p8_form)}


def oracle_sql() -> dict[str, str]:
    return {}
