"""A corpus pipeline: each stage works on the documents that its predecessor kept.

``run`` writes every stage's rows to the shared folder and reads them back, so a lost executor costs one stage.
A corpus is ``documents`` (doc_id, text, lang, source, n_chars); all stages but the last return these columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripstrata.llm.leaks import decontaminated
from tripstrata.llm.mixing import mixture
from tripstrata.llm.near import deduplicated
from tripstrata.llm.quality import good_documents
from tripstrata.llm.queries import table
from tripstrata.llm.scratch import staged
from tripstrata.llm.tokenstore import token_report


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled rows that reach this stage."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return deduplicated(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source as often as its target share of 150 % of the words asks, repeats as rows of their own."""
    return mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, in doc_id order, and what they hold per row: start, n_tokens, ids_crc32."""
    return token_report(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixing", mixing), ("tokens", tokens)]

#: SQL can express neither the classifier nor the tokenizer; ``tests/llm`` compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
