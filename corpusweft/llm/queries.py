"""The subpackage's queries and SQL, added by ``__spark_entry__.py`` if importable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import license_scan, lm_score, mixing, near_dedup, pieces, quality_model, quality_rules, suffix_dedup, token_counts, vp_search
from .shared import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_search.nearest(_table(spark, sf_dir, "embeddings"))


def op2_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.rebuilt(token_counts.TokenRollup(spark, new_path(spark, "rollup")), _table(spark, sf_dir, "documents"))


def word_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with words for tokens, which SQL can count."""
    return token_counts.rebuilt(token_counts.TokenRollup(spark, new_path(spark, "rollup"), token_counts.WORDS), _table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(pieces.encode(_table(spark, sf_dir, "documents"), keep=()))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.cross_entropy_difference(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def base_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op7 that SQL can express."""
    return quality_rules.base_counts(_table(spark, sf_dir, "documents"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_vp_search, op2_token_rollup, op3_sentencepiece, op4_suffix_dedup, op5_lm_scores, op6_mix_sources, op7_quality_rules, op8_simhash_dedup, op9_license_scan, op10_quality_classifier, word_rollup, base_rules)}


def oracle_sql() -> dict[str, str]:
    return {"op4_suffix_dedup": suffix_dedup.REPEATS_SQL, "op6_mix_sources": mixing.MIX_SQL, "op8_simhash_dedup": near_dedup.CLASSES_SQL, "op9_license_scan": license_scan.license_sql(), "word_rollup": token_counts.WORDS_SQL, "base_rules": quality_rules.BASE_SQL}
