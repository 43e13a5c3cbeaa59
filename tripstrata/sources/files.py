"""Folder operations through Hadoop's file system API (local disk, HDFS, object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to the folder has committed."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _locate(spark, source)
    if not fs.rename(old, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a completely written folder in the place of ``path``.

    The old folder is set aside until the new one is in place.  A run that
    stops in between leaves the staged folder whole; :func:`recover` finishes.
    """
    aside = f"{path.rstrip('/')}__previous"
    if exists(spark, path):
        if exists(spark, aside):
            delete(spark, aside)
        rename(spark, path, aside)
    rename(spark, staged, path)
    if exists(spark, aside):
        delete(spark, aside)


def recover(spark: SparkSession, staged: str, path: str) -> None:
    """Finish or undo a :func:`publish` that was interrupted after setting the old folder aside."""
    aside = f"{path.rstrip('/')}__previous"
    if exists(spark, path) or not exists(spark, aside):
        return
    if is_complete(spark, staged):
        rename(spark, staged, path)
        delete(spark, aside)
    else:
        rename(spark, aside, path)
