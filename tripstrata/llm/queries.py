"""The registered queries of the dealt operators: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import counts, credentials, leaks, lm, mixing, near, pagetext, quality, repeats, resampling, search, tokenstore, vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.token_report(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.main_text(table(spark, sf_dir, "pages"))


def op6_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_links(table(spark, sf_dir, "embeddings"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), settings=near.Settings(shingle=4))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_report(table(spark, sf_dir, "documents"), settings=lm.Settings(least=(1, 1, 1)))  # every pair and triple


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_report(table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secret_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_repeats, op3_quality, op4_token_files, op5_main_text, op6_vector_links, op7_decontamination, op8_near_duplicates, op9_language_model, op10_token_counts, op11_resampling, op12_search, op13_secrets)}
