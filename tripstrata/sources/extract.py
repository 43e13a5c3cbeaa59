"""Incremental extracts whose bookmark is committed with the rows it covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import incremental_extract
from . import files
from .writers import write_parquet

EXTRACT = "_extract"


def bookmark(spark: SparkSession, path: str, replication_key: str):
    """The newest ``replication_key`` of the extracts at ``path``; None before the first one."""
    newest = last_extract(spark, path)
    return _extracts(spark, path, newest).agg(F.max(replication_key)).first()[0] if newest else None


def last_extract(spark: SparkSession, path: str) -> int:
    """Number of the newest complete extract; 0 when there is none."""
    if not files.exists(spark, path):
        return 0
    found = spark.read.parquet(path).agg(F.max(EXTRACT)).first()[0] or 0
    return found if found and files.is_complete(spark, f"{path}/{EXTRACT}={found}") else max(found - 1, 0)


def _extracts(spark: SparkSession, path: str, newest: int) -> DataFrame:
    return spark.read.parquet(path).filter(F.col(EXTRACT) <= newest).drop(EXTRACT)


def extract_new(rows: DataFrame, path: str, keys: Sequence[str], replication_key: str, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Write the rows that changed since the last extract as the next one below ``path``, and return them.

    The bookmark is the largest ``replication_key`` that was extracted, so it exists exactly when its rows do: an
    extract that stops is not there, and the next one takes the same rows.  The bound is inclusive, as rows with the
    bookmark's stamp may still have been on their way; those that were extracted already are not taken again.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    newest = last_extract(spark, path)
    since = bookmark(spark, path, replication_key)
    fresh = incremental_extract(rows, keys, replication_key, since, tiebreak)
    if since is not None:
        at_bound = F.col(replication_key) == F.lit(since)
        known = _extracts(spark, path, newest).filter(at_bound).select(*rows.columns)
        fresh = fresh.filter(~at_bound).unionByName(fresh.filter(at_bound).subtract(known))
    target = f"{path}/{EXTRACT}={newest + 1}"
    write_parquet(fresh, target)
    return spark.read.parquet(target)
